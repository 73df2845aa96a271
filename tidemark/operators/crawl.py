"""From a site to the store: editions are discovered, then notices' bodies fetched, in batches.

Requests are made by the driver alone, since a site's limits are for all requests together; what
comes back is parsed and stored as tables, a batch at a time, so a run that stops has kept what
came before.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import body_text, decoded, index_notices, index_status
from ..functions.text import content_hash
from ..schemas import CHUNK, EDITION, HASHED, NOTE, NOTE_REVISION, RUN
from ..sources.fetch import CircuitOpen, PoliteClient, Refused
from ..sources.versioned import Table
from . import changes
from .index import ChunkRule, build_index

#: Pages that are fetched before they are stored.
BATCH = 200
_PAGE = "page string, fecha string, edicion string, url string, body binary, charset string"


def now_text() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def counters() -> dict:
    return {**dict.fromkeys(changes.COUNTERS, 0), "detail": []}


class Store:
    """The tables of a crawl below one folder: notes, their revisions, editions, runs, chunks."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        at = lambda name, schema: Table(spark, f"{root.rstrip('/')}/{name}", schema).ensure()
        self.notes, self.revisions = at("nota", NOTE), at("nota_revision", NOTE_REVISION)
        self.editions, self.runs, self.chunks = at("edition", EDITION), at("run", RUN), at("chunk", CHUNK)

    def upsert(self, incoming: DataFrame, now: str) -> dict[str, int]:
        """Brings in notes (codigo, business fields, content_hash, addresses); every change of a
        tracked field becomes a revision's row. Returns outcomes by name."""
        stored = self.notes.read()
        found = changes.run_counters(changes.upsert_outcomes(stored, incoming))
        diffs = changes.field_diffs(stored, incoming)
        self.revisions.append(diffs.withColumn("changed_at", F.lit(now)))
        self.notes.replace(changes.upsert_notes(stored, incoming, now))
        return {k: found[k] for k in ("inserted", "updated", "unchanged")}

    def set_bodies(self, bodies: DataFrame, now: str) -> dict[str, int]:
        stored = self.notes.read()
        after, outcomes = changes.set_bodies(stored, bodies, now)
        found = changes.run_counters(outcomes.join(bodies.where("body_status = 'ok'").select("codigo"), "codigo", "left_semi"))
        self.notes.replace(after)
        return {k: found[k] for k in ("inserted", "updated", "unchanged")}

    def record_editions(self, seen: DataFrame, now: str) -> int:
        """Returns how many are new or have changed."""
        after, told = changes.record_editions(self.editions.read(), seen, now)
        n = told.where("changed").count()
        self.editions.replace(after)
        return n

    def start_run(self, command: str, now: str | None = None) -> int:
        run_id = 1 + (self.runs.read().agg(F.max("run_id")).head()[0] or 0)
        self.runs.append(changes.ledger_row(self.spark, run_id, command, now or now_text(), None, "running", {}))
        return run_id

    def finish_run(self, run_id: int, found: dict, client: PoliteClient | None = None, status: str = "ok", now: str | None = None) -> None:
        begun = self.runs.read().where(F.col("run_id") == run_id).head()
        if begun is None:
            raise ValueError(f"there is no run {run_id}")
        traffic = {} if client is None else {"requests": client.requests, "retries": client.retries, "bytes_down": client.bytes_down, "slept_s": client.limiter.slept}
        row = changes.ledger_row(self.spark, run_id, begun["command"], begun["started_at"], now or now_text(), status, {**found, **traffic})
        self.runs.upsert(row, ["run_id"])

    def recent_runs(self, limit: int = 10) -> DataFrame:
        return self.runs.read().orderBy(F.desc("run_id")).limit(limit)

    def stats(self) -> DataFrame:
        return changes.store_stats(self.notes.read(), self.editions.read(), self.revisions.read(), self.runs.read())

    def build_index(self, rule: ChunkRule = ChunkRule(), force: bool = False) -> dict[str, int]:
        return build_index(self.chunks, self.notes.read(), rule, force=force)


def _batches(rows: list, size: int = BATCH) -> Iterator[list]:
    for i in range(0, len(rows), size):
        yield rows[i : i + size]


def hashed_notes(notes: DataFrame) -> DataFrame:
    """notes with every column that a store's upsert takes, nulls as empty texts, and their hash."""
    text = ["fecha", "edicion", "seccion", "poder", "organismo", "titulo", "url_detalle", "url_origen"]
    filled = notes.select("codigo", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in notes.columns else F.lit("").alias(c) for c in text])
    return filled.withColumn("content_hash", content_hash(HASHED, exact=["codigo"]))


def _store_pages(store: Store, pages: list[tuple], found: dict, now: str) -> None:
    spark = store.spark
    raw = spark.createDataFrame(pages, _PAGE)
    html = raw.select("page", "fecha", "edicion", "url", decoded(F.col("body"), F.col("charset")).alias("html"))
    walked = index_notices(html)
    status = index_status(html, walked).join(html.select("page", "fecha", "edicion", "url"), "page")
    join = F.udf(lambda base, href: urljoin(base or "", href or ""), "string")
    notes = walked.where("kind = 'notice'").join(html.select("page", "fecha", "edicion", "url"), "page")
    notes = notes.select("codigo", "fecha", "edicion", "seccion", "poder", "organismo", "titulo", join("url", "href").alias("url_detalle"), F.col("url").alias("url_origen"))
    incoming = hashed_notes(notes)
    # a notice on several pages of a batch is that of the last one
    one = incoming.groupBy("codigo").agg(F.max_by(F.struct(*[c for c in incoming.columns if c != "codigo"]), F.struct("fecha", "edicion", "url_origen")).alias("x")).select("codigo", "x.*")
    for k, n in store.upsert(one, now).items():
        found[k] += n
    hashes = changes.page_hash(incoming.select(F.col("fecha"), F.col("edicion"), "content_hash"), ["fecha", "edicion"])
    seen = status.where("status != 'error'").join(hashes, ["fecha", "edicion"], "left")
    seen = seen.select("fecha", "edicion", "status", "n_notas", "n_rejected", F.when(F.col("status") == "ok", F.col("page_hash")).alias("page_hash"), "url")
    store.record_editions(seen, now)
    for r in status.where("status != 'ok'").select("fecha", "edicion", "status").orderBy("fecha", "edicion").collect():
        found["no_edition" if r["status"] == "no_edition" else "errors"] += 1
        if r["status"] == "error":
            found["detail"].append(f"index {r['fecha']}/{r['edicion']}: no notice could be read")


def discover(store: Store, client: PoliteClient, since: date, until: date, editions: tuple[str, ...], base: str, recheck_days: int = 0, today: date | None = None, now: str | None = None) -> dict:
    """Visits the editions of [since, until] that aren't recorded, or are younger than the recheck
    window, and stores their notices. A page without notices is recorded as no edition; one whose
    notices can't be read is an error and isn't recorded, so the next run tries it again. A breaker
    that opens ends the run after what was fetched is stored."""
    spark, found, now = store.spark, counters(), now or now_text()
    wanted = [((since + timedelta(i)).isoformat(), e) for i in range((until - since).days + 1) for e in editions]
    if not wanted:
        return found
    days = spark.createDataFrame(wanted, "fecha string, edicion string")
    visit = changes.editions_to_visit(days, store.editions.read(), (today or date.today()).isoformat(), recheck_days)
    left = sorted((r["fecha"], r["edicion"]) for r in visit.collect())
    for part in _batches(left):
        pages, broken = [], None
        for fecha, edicion in part:
            y, m, d = fecha.split("-")
            url = f"{base}?year={y}&month={m}&day={d}&edicion={edicion}"
            try:
                answer = client.get(url)
            except Refused:
                found["skipped_robots"] += 1
                found["detail"].append(f"robots: index {fecha}/{edicion}")
                continue
            except CircuitOpen as e:
                broken = e
                break
            if answer.status != 200:
                found["errors"] += 1
                found["detail"].append(f"index {fecha}/{edicion}: status {answer.status}")
                continue
            pages.append((f"{fecha}/{edicion}", fecha, edicion, url, answer.body, answer.charset))
        if pages:
            _store_pages(store, pages, found, now)
        if broken:
            raise broken
    return found


def enrich(store: Store, client: PoliteClient, limit: int, body_base: str, retry_errors: bool = False, now: str | None = None) -> dict:
    """Fetches the bodies of the newest notes that lack one. Both a notice's landing page and its
    body's address must be allowed by robots.txt; what isn't is recorded as robots_denied, gone
    ones as not_found, other failures and empty bodies as error."""
    found, now = counters(), now or now_text()
    todo = [(r["codigo"], r["url_detalle"]) for r in changes.pending_bodies(store.notes.read(), limit, retry_errors).select("codigo", "url_detalle").collect()]
    for part in _batches(todo):
        rows, broken = [], None
        for codigo, landing in part:
            url = f"{body_base.rstrip('/')}/{codigo}"
            try:
                if landing and not client.robots.allows(landing):
                    raise Refused(landing)
                answer = client.get(url)
            except Refused:
                found["skipped_robots"] += 1
                rows.append((codigo, "robots_denied", None, None))
                continue
            except CircuitOpen as e:
                broken = e
                break
            if answer.status == 200:
                rows.append((codigo, "ok", answer.body, answer.charset))
            else:
                found["errors"] += 1
                found["detail"].append(f"note {codigo}: status {answer.status}")
                rows.append((codigo, "not_found" if answer.status in (404, 410) else "error", None, None))
        if rows:
            raw = store.spark.createDataFrame(rows, "codigo long, status string, body binary, charset string")
            said = raw.select("codigo", "status", F.nullif(body_text(decoded(F.col("body"), F.col("charset"))), F.lit("")).alias("body_text"))
            empty = (F.col("status") == "ok") & F.col("body_text").isNull()
            bodies = said.select("codigo", F.when(empty, "error").otherwise(F.col("status")).alias("body_status"), "body_text")
            for r in said.where(empty).select("codigo").orderBy("codigo").collect():
                found["errors"] += 1
                found["detail"].append(f"note {r['codigo']}: empty body")
            for k, n in store.set_bodies(bodies, now).items():
                found[k] += n
        if broken:
            raise broken
    return found


def seed(store: Store, path: str, now: str | None = None) -> dict[str, int]:
    """Fills a store and its index from JSON lines of notes (codigo, business fields, body_text),
    as a crawl would have. Returns notes by outcome, bodies, and notes indexed."""
    now = now or now_text()
    kinds = "codigo long, fecha string, edicion string, seccion string, poder string, organismo string, titulo string, url_detalle string, body_text string"
    rows = store.spark.read.schema(kinds).json(path).where("codigo is not null").dropDuplicates(["codigo"])
    out = store.upsert(hashed_notes(rows), now)
    bodies = rows.where("length(body_text) > 0").select("codigo", F.lit("ok").alias("body_status"), "body_text")
    store.set_bodies(bodies, now)
    return {**out, "bodies": bodies.count(), "indexed": store.build_index()["indexed"]}


def report(found: dict) -> str:
    return json.dumps(found, ensure_ascii=False, sort_keys=True)
