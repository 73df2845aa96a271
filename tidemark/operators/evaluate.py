"""Scores of retrieval and answers against a question set, as one plan over all questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import scan
from .answer import extractive
from .ask import ask, no_answers
from .index import ChunkRule, chunk

#: Floors, and ceilings for what is to be avoided.
THRESHOLDS = {"recall@8": 0.90, "hit_rate@8": 0.90, "routing_accuracy": 0.95, "refusal_rate_unanswerable": 0.50, "over_refusal_rate_answerable": 0.10}
ABLATIONS = {
    "baseline": {},
    "no folding": {"folded": False},
    "no prefixes": {"use_prefix": False},
    "no expansion": {"use_expansion": False},
    "no pre-filter": {"use_prefilter": False},
    "no expansion, no pre-filter": {"use_expansion": False, "use_prefilter": False},
    "chunks 600/80": {"chunk_chars": 600, "overlap": 80},
    "chunks 2400/300": {"chunk_chars": 2400, "overlap": 300},
}


def containing(notes: DataFrame, passages: DataFrame) -> DataFrame:
    """(q, codigo): which notes (codigo, text) contain which passages (q, passage). The passages are
    sent to all tasks; a note is read once for all of them."""
    rows = [(q, p) for q, p in passages.select("q", "passage").collect() if p is not None]
    sought = scan.Passages([p for _, p in rows])
    own = {f.name: f.dataType for f in (*notes.schema.fields, *passages.schema.fields)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = pa.array([q for q, _ in rows], to_arrow_type(own["q"]))
        for batch in batches:
            for piece in scan.pieces(batch, ["text"]):
                texts, which = sought.found(piece.column("text"))
                yield pa.RecordBatch.from_arrays([q.take(pa.array(which)), piece.column("codigo").take(pa.array(texts))], ["q", "codigo"])

    return notes.select("codigo", "text").mapInArrow(run, T.StructType([T.StructField("q", own["q"]), T.StructField("codigo", own["codigo"])]))


def question_results(gold: DataFrame, corpus: DataFrame, plans: DataFrame, retrieved: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """A row per question: id, kind, skipped, routed, recall, hit, refused, and with answers their
    citations' precision and recall.

    gold is (id, kind, strategy, gold_codigos), corpus (codigo), plans (q, strategy,
    refused_because), retrieved (q, rank, codigo), answers (q, sufficient, citations). A question
    with gold of which the corpus has nothing is skipped. recall is -1 without gold. refused is a
    gate's reason, or with answers also an insufficient answer.
    """
    have = gold.select("id", F.explode("gold_codigos").alias("codigo")).join(corpus.select("codigo").distinct(), "codigo", "left_semi").groupBy("id").agg(F.count("*").alias("there"))
    got = retrieved.groupBy("q").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rank", "codigo"))), lambda r: r["codigo"])).alias("codes"))
    none = F.array().cast("array<bigint>")
    e = gold.join(have, "id", "left").join(plans.select(F.col("q").alias("id"), F.col("strategy").alias("routed_to"), "refused_because"), "id", "left").join(got.select(F.col("q").alias("id"), "codes"), "id", "left")
    golden, codes = F.coalesce("gold_codigos", none), F.coalesce("codes", none)
    found = F.size(F.array_intersect(golden, codes))
    answerable = F.col("kind") == "answerable"
    skipped = answerable & (F.size(golden) > 0) & F.col("there").isNull()
    refused = F.col("refused_because").isNotNull()
    cols: list[Column] = []
    if answers is not None:
        e = e.join(answers.select(F.col("q").alias("id"), "sufficient", "citations"), "id", "left")
        cited = F.coalesce("citations", none)
        good = F.size(F.array_intersect(cited, golden))
        refused = refused | ~F.coalesce("sufficient", F.lit(False))
        counted = answerable & ~skipped & ~refused & (F.size(golden) > 0)
        cols = [F.when(counted, F.when(F.size(cited) > 0, good / F.size(cited)).otherwise(0.0)).alias("citation_precision"), F.when(counted, good / F.size(golden)).alias("citation_recall")]
    recall = F.when(F.size(golden) == 0, -1.0).otherwise(found / F.size(golden))
    return e.select("id", "kind", skipped.alias("skipped"), (F.col("strategy") == F.col("routed_to")).alias("routed"), recall.alias("recall"), F.when(F.size(golden) > 0, (found > 0).cast("int")).alias("hit"), refused.alias("refused"), *cols)


def summarise(results: DataFrame, k: int = 8, by: list[str] | None = None) -> DataFrame:
    """Means over the questions that aren't skipped, to four places; none is zero."""
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 4)
    yes = F.col("kind") == "answerable"
    scored = yes & (F.col("recall") >= 0)
    refused = F.col("refused").cast("int")
    aggs = [F.count("*").alias("n_questions"), mean(F.when(scored, F.col("recall"))).alias(f"recall@{k}"), mean(F.when(scored, F.col("hit"))).alias(f"hit_rate@{k}"), mean(F.col("routed").cast("int")).alias("routing_accuracy"), mean(F.when(~yes, refused)).alias("refusal_rate_unanswerable"), mean(F.when(yes, refused)).alias("over_refusal_rate_answerable")]
    with_answers = "citation_precision" in results.columns
    if with_answers:
        aggs += [mean(F.col("citation_precision")).alias("citation_precision"), mean(F.col("citation_recall")).alias("citation_recall")]
    out = results.where("not skipped").groupBy(*(by or [])).agg(*aggs)
    if with_answers:
        p, r = F.col("citation_precision"), F.col("citation_recall")
        out = out.withColumn("citation_f1", F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 4))
    return out


def failures(metrics: dict[str, float], thresholds: dict[str, float] | None = None) -> list[str]:
    """What misses its floor or ceiling. A metric that wasn't measured fails too."""
    out = []
    for name, limit in (thresholds or THRESHOLDS).items():
        value, ceiling = metrics.get(name), name.startswith("over_refusal")
        if value is None:
            out.append(f"{name} was not measured")
        elif (value > limit) if ceiling else (value < limit):
            out.append(f"{name} is {value}, {'above' if ceiling else 'below'} {limit}")
    return out


def ablation(results: DataFrame, k: int = 8, baseline: str = "baseline") -> DataFrame:
    """Summaries of results with a `variant` column, and what each recall and hit rate differs from
    the baseline's."""
    s = summarise(results, k, ["variant"])
    names = [f"recall@{k}", f"hit_rate@{k}", "over_refusal_rate_answerable"]
    base = F.broadcast(s.where(F.col("variant") == baseline).select(*[F.col(f"`{n}`").alias(f"base {n}") for n in names]))
    return s.join(base).select("variant", *[F.col(f"`{n}`") for n in names], *[F.round(F.col(f"`{n}`") - F.col(f"`base {n}`"), 4).alias(f"delta {n}") for n in names])


def run(gold: DataFrame, notes: DataFrame, chunks: DataFrame, provider: Callable[[DataFrame], DataFrame] | None = extractive, k: int = 8, **options) -> DataFrame:
    """question_results of a question set (id, question, kind, strategy, gold_codigos, today) that
    is asked of notes and their chunks. Notes that an exact plan lists count as retrieved. Without
    a provider nothing is generated, and only gates refuse."""
    asked = ask(gold.select(F.col("id").alias("q"), "question", "today"), notes, chunks, provider or no_answers, k, **options)
    listed = asked.answers.where("strategy = 'sql'").select("q", F.posexplode("citations").alias("i", "codigo")).select("q", (F.col("i") + 1).alias("rank"), "codigo")
    got = asked.hits.select("q", "rank", "codigo").union(listed)
    plans = asked.answers.select("q", "strategy", "refused_because")
    answers = None if provider is None else asked.answers.select("q", "sufficient", "citations")
    return question_results(gold, notes.select("codigo"), plans, got, answers)


def evaluate(gold: DataFrame, notes: DataFrame, chunks: DataFrame, provider: Callable[[DataFrame], DataFrame] | None = extractive, k: int = 8, **options) -> dict:
    """A report: metrics, counts, and a row for each question."""
    rows = run(gold, notes, chunks, provider, k, **options).persist()
    try:
        metrics = {c: v for c, v in summarise(rows, k).head().asDict().items() if c != "n_questions"}
        yes = (F.col("kind") == "answerable") & ~F.col("skipped")
        n = rows.agg(F.count("*").alias("total"), F.count_if(~F.col("skipped")).alias("scored"), F.count_if("skipped").alias("skipped_not_in_corpus"), F.count_if(yes).alias("answerable"), F.count_if(yes & (F.col("recall") >= 0)).alias("answerable_with_gold"), F.count_if(~F.col("skipped") & (F.col("kind") != "answerable")).alias("unanswerable"))
        return {"generation": provider is not None, "k": k, "counts": n.head().asDict(), "metrics": metrics, "questions": [r.asDict() for r in rows.orderBy("id").collect()]}
    finally:
        rows.unpersist()


def ablate(gold: DataFrame, notes: DataFrame, k: int = 8, variants: dict[str, dict] | None = None) -> DataFrame:
    """The ablation table of all variants, one plan over the question set for each, without
    generation. A variant may change how notes are cut, how words are folded, and how passages are
    sought; what it leaves out is as in the baseline."""
    parts = []
    for name, change in (variants or ABLATIONS).items():
        rule = ChunkRule(**{f: change[f] for f in ("chunk_chars", "overlap") if f in change})
        folded = change.get("folded", True)
        rest = {f: v for f, v in change.items() if f not in ("chunk_chars", "overlap", "folded")}
        usable = notes.where("body_status = 'ok' and length(trim(body_text)) > 0")
        rows = run(gold, notes, chunk(usable, rule, folded), None, k, folded=folded, **rest)
        parts.append(rows.select("id", "kind", "skipped", "routed", "recall", "hit", "refused", F.lit(name).alias("variant")))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return ablation(both, k, next(iter(variants or ABLATIONS)))


def render(metrics: dict[str, float], title: str = "evaluation") -> str:
    width = max(map(len, metrics), default=0)
    return "\n".join([title, *[f"  {n:<{width}}  {v}" for n, v in metrics.items()]])
