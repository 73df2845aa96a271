"""Schemas of all tables, never inferred."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

TEXT, LONG = StringType(), LongType()


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(f[0], f[1] if len(f) > 1 else TEXT, f[2] if len(f) > 2 else True) for f in fields])


_BUSINESS = [("fecha",), ("edicion",), ("seccion",), ("poder",), ("organismo",), ("titulo",), ("url_detalle",)]
SNAPSHOT = _struct(("codigo", LONG, False), *_BUSINESS, ("content_hash",), ("body_hash",), ("body_status",), ("revision", LONG), ("first_seen_at",), ("last_seen_at",), ("last_changed_at",), ("body_text",))
BRONZE = StructType([*SNAPSHOT.fields, StructField("_snapshot_date", DateType(), False), StructField("_ingested_at", TimestampType(), False)])
SILVER = _struct(("codigo", LONG, False), ("revision", LONG, False), ("fecha", DateType()), *_BUSINESS[1:], ("content_hash",), ("body_hash",), ("body_status",), ("body_text",), ("valid_from", DateType()), ("valid_to", DateType()), ("is_current", BooleanType(), False))
NOTE = _struct(("codigo", LONG, False), *_BUSINESS, ("url_origen",), ("content_hash",), ("body_text",), ("body_hash",), ("body_status",), ("body_fetched_at",), ("revision", LONG), ("first_seen_at",), ("last_seen_at",), ("last_changed_at",))
NOTE_REVISION = _struct(("codigo", LONG, False), ("revision", LONG), ("changed_at",), ("field",), ("old_value",), ("new_value",))
EDITION = _struct(("fecha",), ("edicion",), ("status",), ("n_notas", LONG), ("n_rejected", LONG), ("page_hash",), ("url",), ("first_seen_at",), ("last_seen_at",), ("last_changed_at",))
RUN = _struct(("run_id", LONG, False), ("command",), ("started_at",), ("finished_at",), ("status",), *[(c, LONG) for c in ("inserted", "updated", "unchanged", "skipped_robots", "no_edition", "errors", "requests", "retries", "bytes_down")], ("slept_s", DoubleType()), ("detail",))
CHUNK = _struct(("codigo", LONG, False), ("chunk_ix", LONG), ("texto",), ("n_chars", LONG), ("char_start", LONG), ("char_end", LONG), ("titulo",), ("organismo",), ("signature",))

#: Fields whose changes are recorded one by one, and those that the content hash covers.
TRACKED = ("titulo", "organismo", "poder", "seccion", "fecha", "edicion")
HASHED = ("codigo", "edicion", "fecha", "organismo", "poder", "seccion", "titulo")


def ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
