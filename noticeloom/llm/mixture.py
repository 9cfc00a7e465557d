"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer. A source gives complete epochs first; the rest of its budget is a sample without
replacement by Efraimidis-Spirakis keys: exponential variables divided by the weight of each document, taken in
increasing order until the prefix sum of sizes meets the budget. Prefix sums run over ranges of the key, so that only
the range in which the budget ends is ever sorted.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..runtime import Scratch, broadcast_if_small
from . import quality

#: A public vocabulary as ranks, and the pattern by which text is cut before pairs are merged.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the usual cutting pattern of byte-level vocabularies of this size.
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ranges of the key for each factor e by which it grows. Keys are exponential, whatever the weights, so that none of these
#: ranges holds more than a share of 0.4 / RANGES of a source.
RANGES = 256


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("file", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of the whole text; 0 for null."""
    return len(_encoding(path).encode_ordinary(text)) if text else 0


def source_key(label: Column) -> Column:
    """A source's label without case, blanks, hyphens and underscores."""
    return F.lower(F.regexp_replace(label, r"[\s\x{3000}\x{00A0}_\-\x{2010}-\x{2015}\x{FF0D}\x{FF3F}]+", ""))


def budgets(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Tokens to draw from each source. targets: share and greatest number of repeats.

    Without a total, the greatest one at which all sources that hold anything keep their shares exactly (among
    themselves, if others are absent). With a total, each source gets its share of it, at most its size times repeats;
    what a small source cannot give goes to the others in proportion to their shares.
    """
    there = {s: (share, sizes[s] * repeats) for s, (share, repeats) in targets.items() if sizes.get(s, 0) * repeats > 0 and share > 0}
    if not there:
        return {}
    if total is None:
        total = min(most / share for share, most in there.values()) * sum(share for share, _ in there.values())
    out, open_ = {}, dict(there)
    while open_:
        left, weight = total - sum(out.values()), sum(share for share, _ in open_.values())
        full = {s: most for s, (share, most) in open_.items() if left * share / weight >= most * (1 - 1e-12)}
        if not full:
            return out | {s: left * share / weight for s, (share, _) in open_.items()}
        out |= full
        open_ = {s: x for s, x in open_.items() if s not in full}
    return out


class Mixture:
    """The drawn documents and the shares reached."""

    def __init__(self, drawn: DataFrame, report: DataFrame):
        self.drawn, self.report = drawn, report


def mix(docs: DataFrame, targets: DataFrame, *, total: float | None = None, tokenizer: str = TOKENIZER, seed: str = "mix", ranges: int = RANGES) -> Mixture:
    """Draw documents so that sources reach their target shares of all tokens.

    docs: doc_id, text, source; targets: source, target_share, max_repeats. `drawn`: doc_id, source (as in targets),
    n_tokens, copies >= 1. `report`: source, target_share, max_repeats, documents, tokens, drawn_tokens, share,
    most_copies, one row for each target, absent sources with 0. Documents without tokens or of other sources are never
    drawn; a repeated doc_id counts once, with its longest text; a text repeated under several ids is several documents.
    The same seed draws the same documents. Totals are met to within half a document for each source.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    wanted = targets.where("source is not null").groupBy(source_key(F.col("source")).alias("key")).agg(F.min("source").alias("source"), F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    goals = {r.key: r for r in wanted.toLocalIterator()}  # one row for each target source

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "key": pdf["key"], "weight": pdf["weight"], "n_tokens": [token_count(t, tokenizer) for t in pdf["text"]]})

    shape = quality.measures(F.col("text"))
    weight = F.greatest(F.lit(0.05), (1 - shape["symbol_share"]) * (0.5 + 0.5 * shape["line_end_share"]))
    eligible = docs.select("doc_id", source_key(F.col("source")).alias("key"), "text").where(F.col("key").isin(list(goals)) & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    counted = eligible.withColumn("weight", weight).mapInPandas(count, "doc_id long, key string, weight double, n_tokens long")
    unique = counted.groupBy("doc_id", "key").agg(F.max("n_tokens").alias("n_tokens"), F.max("weight").alias("weight")).where("n_tokens > 0")
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = unique.withColumn("order", -F.log(uniform) / F.col("weight"))
    pool = scratch.keep(keyed.withColumn("range", F.floor(ranges * F.log(F.greatest("order", F.lit(1e-300)))).cast("int")))
    sizes = {r.key: r for r in pool.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")).toLocalIterator()}
    drawn = budgets({k: r.tokens for k, r in sizes.items()}, {k: (r.target_share or 0.0, r.max_repeats or 0) for k, r in goals.items()}, total)
    rows = []
    for key, r in goals.items():
        have, want = sizes[key].tokens if key in sizes else 0, drawn.get(key, 0.0)
        epochs = int(want / have + 1e-9) if have else 0
        rows.append((key, r.source, r.target_share, r.max_repeats, sizes[key].documents if key in sizes else 0, have, epochs, max(0.0, want - epochs * have)))
    plan = spark.createDataFrame(rows, "key string, source string, target_share double, max_repeats int, documents long, tokens long, epochs int, rest double")
    before = W.Window.partitionBy("key").orderBy("range").rowsBetween(W.Window.unboundedPreceding, -1)
    sums = pool.groupBy("key", "range").agg(F.sum("n_tokens").alias("in_range"))
    sums = scratch.keep(sums.withColumn("earlier", F.coalesce(F.sum("in_range").over(before), F.lit(0))))
    placed = pool.join(broadcast_if_small(sums), ["key", "range"]).join(F.broadcast(plan.select("key", "source", "epochs", "rest")), "key")
    sure = placed.where("earlier + in_range <= rest").withColumn("taken", F.lit(1))
    none = placed.where("earlier >= rest").withColumn("taken", F.lit(0))
    edge = placed.where("earlier < rest and earlier + in_range > rest")
    running = W.Window.partitionBy("key").orderBy("order", "doc_id").rowsBetween(W.Window.unboundedPreceding, 0)
    edge = edge.withColumn("sum", F.col("earlier") + F.sum("n_tokens").over(running))
    nearer = (F.col("sum") - F.col("n_tokens") < F.col("rest")) & (F.col("sum") - F.col("rest") < F.col("rest") - F.col("sum") + F.col("n_tokens"))
    edge = edge.withColumn("taken", ((F.col("sum") <= F.col("rest")) | nearer).cast("int")).drop("sum")
    every = sure.unionByName(none).unionByName(edge).select("doc_id", "source", "n_tokens", (F.col("epochs") + F.col("taken")).alias("copies")).where("copies > 0")
    got = scratch.keep(every)
    reached = got.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn_tokens"), F.max("copies").alias("most_copies"))
    report = plan.select("source", "target_share", "max_repeats", "documents", "tokens").join(reached, "source", "left")
    report = report.withColumn("drawn_tokens", F.coalesce("drawn_tokens", F.lit(0))).withColumn("most_copies", F.coalesce("most_copies", F.lit(0)))
    # a window over one row for each target
    every_token = F.sum("drawn_tokens").over(W.Window.partitionBy(F.lit(1)))
    report = report.withColumn("share", F.when(every_token > 0, F.col("drawn_tokens") / every_token).otherwise(0.0))
    return Mixture(got, report.select("source", "target_share", "share", "max_repeats", "most_copies", "documents", "tokens", "drawn_tokens"))
