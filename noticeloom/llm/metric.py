"""Exact radius joins of short strings under the edit distance, by metric-space partitioning.

A cell of strings is divided by a pivot and a cut: strings at most `cut` away from the pivot lie inside, the others
outside. By the triangle inequality two strings within the radius on both sides of the cut lie in the shell of that
width around it, so the shell of one side, whichever is thinner, is replicated to the other. A replica only meets strings
that belong to the cell, so every pair is met in one cell, where the edit distance itself decides.

Distances of short strings crowd around few values, so that shells can be thick. A cell is therefore divided by further
pivots only while that costs less than it saves. In a small cell strings are compared pair by pair, behind further
divisions; in one that stays crowded, those pairs are compared that share what is left after a deletion.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Scratch, spread

#: Strings of a crowded cell from which its pivots are chosen, and pivots tried for each division. Every string is placed.
PIVOT_SAMPLE, PIVOTS = 4000, 10
#: Rows of a cell that one task takes, and rows of the cells that it compares pair by pair.
CELL_ROWS, PAIR_ROWS = 2000, 40
#: A pivot fits into one machine word.
LONGEST_PIVOT = 60
#: Strings longer than this are divided by length alone.
LONG = 48
#: A division must leave at most this share of the rows on each side, and of the pairs together.
WORTH = 0.9
#: Comparisons of two strings that cost as much as one row sent.
PAIRS_A_ROW = 200
MET = "block string, a string, b string, distance int"


def distances(pivots: list[str], strings: list[str]) -> np.ndarray:
    """Edit distances, one row for each string and one column for each pivot, by bit-parallel rows (Myers)."""
    out = np.zeros((len(strings), len(pivots)), np.int32)
    for part, codes, lengths in _parts(strings):
        signs, place = np.unique(codes, return_inverse=True)
        place = place.reshape(codes.shape)
        for column, pivot in enumerate(pivots):
            m = len(pivot)
            if not m:
                out[part, column] = lengths
                continue
            equal = np.zeros(len(signs), np.uint64)
            for i, c in enumerate(pivot):
                equal[signs == ord(c)] |= np.uint64(1 << i)
            top, one = np.uint64(m - 1), np.uint64(1)
            plus, minus = np.full(len(part), np.uint64((1 << m) - 1)), np.zeros(len(part), np.uint64)
            score = np.full(len(part), m)
            for j in range(codes.shape[1]):
                eq = equal[place[:, j]]
                xv = eq | minus
                xh = (((eq & plus) + plus) ^ plus) | eq
                ph, mh = minus | ~(xh | plus), plus & xh
                score += np.where(j < lengths, ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64), 0)
                ph, mh = (ph << one) | one, mh << one
                plus, minus = mh | ~(xv | ph), ph & xv
            out[part, column] = score
    return out


def _parts(strings: list[str], rows: int = 8192, cells: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, code points (0 behind the end) and lengths of strings of rising length, in parts of bounded size."""
    order = np.argsort([len(s) for s in strings], kind="stable")
    begin = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or i - begin >= rows or (i - begin + 1) * len(strings[order[i]]) > cells:
            part = order[begin:i]
            yield part, *_codes([strings[k] for k in part])
            begin = i


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], int)
    codes = np.zeros((len(texts), int(lengths.max(initial=0))), np.uint32)
    for row, t in enumerate(texts):
        codes[row, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, lengths


def within(codes: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Distances of the strings a[i] and b[i], radius + 1 if above it, in a band around the diagonal."""
    n, band, most = len(a), 2 * radius + 1, radius + 1
    if not n:
        return np.zeros(0, np.int16)
    la, lb = lengths[a], lengths[b]
    row = np.full((band + 2, n), most, np.int16)
    for k in range(radius, band):
        row[k + 1] = k - radius
    out = np.where(la == 0, np.minimum(lb, most), most).astype(np.int16)
    for i in range(1, int(la.max()) + 1):
        sign, now = codes[a, i - 1], np.full_like(row, most)
        for k in range(band):
            j = i + k - radius
            if j == 0:
                now[k + 1] = min(i, most)
            elif 0 < j <= codes.shape[1]:
                differ = codes[b, j - 1] != sign
                now[k + 1] = np.minimum(np.minimum(row[k + 1] + differ, np.minimum(row[k + 2], now[k]) + 1), most)
        row = now
        ends = np.flatnonzero(la == i)
        place = lb[ends] - i + radius
        inside = (place >= 0) & (place < band)
        out[ends[inside]] = row[place[inside] + 1, ends[inside]]
    return out


def _sides(d: np.ndarray, native: np.ndarray, cut: int, outward: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Who is inside and who is outside. Natives lie on one side and, in the shell, are replicated to the other; replicas go
    wherever a native within the radius may be."""
    inside, outside = d <= cut, d > cut
    return inside | (d <= cut + radius) & (~native | (not outward)), outside | (d > cut - radius) & (~native | outward)


def _divide(strings: list[str], native: np.ndarray, radius: int, tried: int, seed: int) -> tuple[str, int, bool] | None:
    """The pivot, cut and direction of replicas that leave the fewest pairs; None if no division is worth it."""
    random = np.random.default_rng(seed)
    some = random.permutation(len(strings))[:300]
    known, held = [strings[i] for i in some], native[some]
    pivots = [""] + ([] if max(map(len, known)) > LONG else [p for p in dict.fromkeys(known[:tried]) if p])
    best, least = None, WORTH
    for pivot, d in zip(pivots, distances(pivots, known).T):
        for cut in range(int(d.min()), int(d.max())):
            for outward in (True, False):
                inside, outside = _sides(d, held, cut, outward, radius)
                if max(inside.sum(), outside.sum()) > WORTH * len(some):
                    continue
                pairs = sum(x.sum() * (x & held & y).sum() for x, y in ((inside, d <= cut), (outside, d > cut)))
                cost = pairs / max(1, len(some) * held.sum())
                if cost < least:
                    best, least = (pivot, cut, outward), cost
    return best


@dataclass(eq=False)
class _Cell:
    """A cell while its tree is grown. least: what it costs at least, as far as its parts are known."""

    at: np.ndarray
    held: np.ndarray
    seed: int
    above: _Cell | None
    here: float  # cost of the cell as it is
    least: float
    cutting: tuple[str, int, bool] | None = None
    parts: list[_Cell] = field(default_factory=list)

    def given_up(self) -> bool:
        cell = self.above
        while cell and cell.parts:
            cell = cell.above
        return cell is not None

    def costs(self, least: float) -> None:
        """At least so much; cells above that cost no more as they are lose their parts."""
        cell = self
        while cell:
            more, cell.least = min(least, cell.here) - cell.least, min(least, cell.here)
            if least >= cell.here:
                cell.parts = []
            cell, least = cell.above, cell.above.least + more if cell.above else 0.0

    def nested(self) -> tuple | None:
        return (*self.cutting, *(p.nested() for p in self.parts)) if self.parts else None


def _tree(strings: list[str], native: np.ndarray, radius: int, tried: int, scale: float, rows: int) -> tuple[float, tuple | None]:
    """Cost in rows sent, and nested (pivot, cut, outward, inside, outside) or None for a cell that is left as it is. The
    strings are one in `scale` of the cell's.

    The tree grows level by level. Parts cost at least the rows in them, so a cell is left as it is, and its parts are not
    divided on, as soon as those rows are as many as it costs: the work is that many rows a level, not all parts of parts.
    """
    length = np.array([len(s) for s in strings], int)

    def cell(at: np.ndarray, held: np.ndarray, seed: int, above: _Cell | None = None) -> _Cell:
        n = len(at)
        here = n * (1 + min(n * scale / PAIRS_A_ROW, float(length[at].mean()) if n else 0.0))
        return _Cell(at, held, seed, above, here, float(n))

    root = cell(np.arange(len(strings)), native, 1)
    level = [root]
    while level:
        below = []
        for c in level:
            if c.given_up():
                continue
            n, texts = len(c.at), [strings[i] for i in c.at]
            c.cutting = _divide(texts, c.held, radius, tried, c.seed) if n * scale > rows and n > 8 else None
            if c.cutting:
                pivot, cut, outward = c.cutting
                d = distances([pivot], texts)[:, 0]
                sides = list(zip(_sides(d, c.held, cut, outward, radius), (d <= cut, d > cut)))
                if not any(there.all() for there, _ in sides):
                    c.parts = [cell(c.at[there], (c.held & own)[there], c.seed * 2 + k, c) for k, (there, own) in enumerate(sides)]
                    below += c.parts
            c.costs(sum(part.least for part in c.parts) if c.parts else c.here)
        level = below
    return root.least, root.nested()


def _place(tree, strings: list[str], native: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of each cell, who is in it, and who of those belongs there."""
    todo = [(tree, 1, np.arange(len(strings)), native)]
    while todo:
        node, number, at, held = todo.pop()
        if node is None or not len(at):
            yield number, at, held
            continue
        pivot, cut, outward, *parts = node
        d = distances([pivot], [strings[i] for i in at])[:, 0]
        for side, (here, own) in enumerate(zip(_sides(d, held, cut, outward, radius), (d <= cut, d > cut))):
            todo.append((parts[side], (number * 2 + side) % (1 << 61), at[here], (held & own)[here]))


def _joined(strings: list[str], native: np.ndarray, visits: np.ndarray, radius: int, tried: int, rows: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (a, b, distance) of one cell, by dividing it on and comparing the strings of the parts."""
    codes, lengths = _codes([s if len(s) <= LONG else "" for s in strings])
    real = np.array([len(s) for s in strings], int)
    found = []
    todo = [(np.arange(len(strings)), native, 1)]
    while todo:
        at, held, seed = todo.pop()
        if not held.any():
            continue
        if cutting := _divide([strings[i] for i in at], held, radius, tried, seed) if len(at) > rows else None:
            pivot, cut, outward = cutting
            d = distances([pivot], [strings[i] for i in at])[:, 0]
            sides = [(at[here], (held & own)[here]) for here, own in zip(_sides(d, held, cut, outward, radius), (d <= cut, d > cut))]
            if all(len(x) < len(at) for x, _ in sides):
                todo += [(x, h, seed * 2 + k) for k, (x, h) in enumerate(sides)]
                continue
        rank, step = np.arange(len(at)), max(1, 400_000 // len(at))
        for begin in range(0, len(at), step):
            some = rank[begin : begin + step]
            ok = held[some][:, None] & (~held[None, :] | (some[:, None] < rank[None, :])) & (visits[at[some]][:, None] | visits[at][None, :])
            ok &= np.abs(real[at[some]][:, None] - real[at][None, :]) <= radius
            x, y = np.nonzero(ok)
            a, b = at[some[x]], at[y]
            short = (real[a] <= LONG) & (real[b] <= LONG)
            near = np.full(len(a), radius + 1)
            near[short] = within(codes, lengths, a[short], b[short], radius)
            for i in np.flatnonzero(~short):
                near[i] = _far(strings[a[i]], strings[b[i]], radius)
            keep = (near <= radius) & (a != b)
            found.append((a[keep], b[keep], near[keep]))
    return found


def _far(x: str, y: str, radius: int) -> int:
    """Distance of two long strings, without what they share at both ends."""
    begin = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    x, y = x[begin:], y[begin:]
    end = next((i for i, (p, q) in enumerate(zip(reversed(x), reversed(y))) if p != q), min(len(x), len(y)))
    codes, lengths = _codes([x[: len(x) - end], y[: len(y) - end]])
    return int(within(codes, lengths, np.array([0]), np.array([1]), radius)[0])


def _keys(text: str, radius: int, member: bool) -> set[str]:
    """Keys of which two strings within the radius share one. Short strings: what is left after at most `radius` deletions.
    Long ones: one of radius + 1 segments of the member is untouched and lies at most `radius` away in the visitor."""
    keys = set()
    if len(text) <= LONG + radius:
        keys |= {"".join(c for i, c in enumerate(text) if i not in gone) for k in range(radius + 1) for gone in combinations(range(len(text)), k)}
    if len(text) > LONG:
        for length in {len(text)} if member else range(max(LONG + 1, len(text) - radius), len(text) + radius + 1):
            cuts = [length * i // (radius + 1) for i in range(radius + 2)]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                keys |= {f"{length}/{i}/{text[lo + shift : hi + shift]}" for shift in ((0,) if member else range(-radius, radius + 1)) if lo + shift >= 0 and hi + shift <= len(text)}
    elif not member:  # a longer member may be just above
        for length in range(LONG + 1, len(text) + radius + 1):
            cuts = [length * i // (radius + 1) for i in range(radius + 2)]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                keys |= {f"{length}/{i}/{text[lo + shift : hi + shift]}" for shift in range(-radius, radius + 1) if lo + shift >= 0 and hi + shift <= len(text)}
    return keys


def radius_join(strings: DataFrame, radius: int = 1, sample: int = PIVOT_SAMPLE, pivots: int = PIVOTS, scratch: Scratch | None = None, rows: int = CELL_ROWS) -> DataFrame:
    """block, a, b, distance: all pairs a < b of different values of the column `s` of `strings` within `radius`; with a
    column `visits`, those pairs of which at least one visits; with a column `block`, those of equal blocks (else it is
    empty).

    Exact for every radius; null and empty values have no partners, repeated values count once. Each round divides all cells
    of more than `rows` rows by pivots from a sample of each, while that costs less than it saves; the trees sent to the
    tasks take some 40 bytes for each cell. In cells that stay crowded the rows are spread over what is left after deletions.
    """
    spark = strings.sparkSession
    scratch = scratch or Scratch(spark)
    column = lambda name, other: F.col(name) if name in strings.columns else other
    all_ = strings.where("length(s) > 0").groupBy(F.coalesce(column("block", F.lit("")), F.lit("")).cast("string").alias("block"), "s").agg(F.max(column("visits", F.lit(True))).alias("visits"))
    schema = "cell long, block string, s string, visits boolean, native boolean"
    open_, done = scratch.keep(all_.select(F.xxhash64("block").alias("cell"), "block", "s", "visits", F.lit(True).alias("native"))), []

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = _tree(pdf["s"].tolist(), pdf["native"].to_numpy(bool), radius, pivots, float(pdf["n"].iloc[0]) / len(pdf), rows)[1]
        return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "tree": [pickle.dumps(tree)], "divided": [tree is not None]})

    while True:
        sizes = open_.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("native").alias("own")).where((F.col("n") > rows) & (F.col("own") > 0)).drop("own")
        if not (full := sizes.limit(1).count()):
            done.append(open_)
            break
        drawn = open_.join(sizes, "cell").where(F.pmod(F.xxhash64("s", F.lit(7)), F.lit(1 << 20)) < sample / F.col("n") * (1 << 20))
        grown = scratch.keep(drawn.groupBy("cell").applyInPandas(grow, "cell long, tree binary, divided boolean"))
        trees = {r.cell: bytes(r.tree) for r in grown.where("divided").toLocalIterator()}
        if not trees:
            done.append(open_)
            break
        sent = spark.sparkContext.broadcast(trees)
        crowded = grown.where("divided").select("cell")
        done.append(open_.join(F.broadcast(crowded), "cell", "left_anti"))

        def place(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for cell, part in pdf.groupby("cell"):
                    for number, at, held in _place(pickle.loads(sent.value[cell]), part["s"].tolist(), part["native"].to_numpy(bool), radius):
                        if len(at):
                            mixed = (int(cell) * 0x9E3779B97F4A7C15 + number * 0xC2B2AE3D27D4EB4F) & ((1 << 64) - 1)
                            yield part.iloc[at].assign(cell=mixed - (1 << 63), native=held)[["cell", "block", "s", "visits", "native"]]

        open_ = scratch.keep(spread(open_.join(F.broadcast(crowded), "cell"), "s").mapInPandas(place, schema))
    cells = done[0]
    for more in done[1:]:
        cells = cells.unionByName(more)
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        texts, block = pdf["s"].tolist(), pdf["block"].iloc[0]
        found = _joined(texts, pdf["native"].to_numpy(bool), pdf["visits"].to_numpy(bool), radius, pivots, PAIR_ROWS)
        out = [(block, *sorted((texts[i], texts[j])), int(k)) for part in found for i, j, k in zip(*part)]
        return pd.DataFrame(out, columns=["block", "a", "b", "distance"])

    if not full:
        return cells.groupBy("cell").applyInPandas(meet, MET)
    sized = cells.groupBy("cell").agg(F.count("*").alias("n"))
    crowded = scratch.keep(sized.where(F.col("n") > rows).select("cell"))  # at most one for each `rows` rows
    small, large = cells.join(F.broadcast(crowded), "cell", "left_anti"), cells.join(F.broadcast(crowded), "cell", "left_semi")

    def come(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for cell, block, s, goes, own in zip(pdf["cell"], pdf["block"], pdf["s"], pdf["visits"], pdf["native"]):
                there = _keys(s, radius, True)
                coming = _keys(s, radius, False) if goes else set()
                out += [(cell, block, x, s, x in there, x in coming, own) for x in there | coming]
            yield pd.DataFrame(out, columns=["cell", "block", "left", "s", "member", "comes", "native"])

    near = small.groupBy("cell").applyInPandas(meet, MET)
    # a string crosses the exchange with a hash of cell and remainder; the strings themselves are compared afterwards
    came = spread(large, "s").mapInPandas(come, "cell long, block string, left string, s string, member boolean, comes boolean, native boolean")
    came = scratch.keep(came.select(F.xxhash64("cell", "left").alias("key"), "block", "s", "member", "comes", "native"))
    there = came.where("member").select("key", "block", F.col("s").alias("x"), F.col("native").alias("own"))
    met = there.join(came.where("comes").select("key", F.col("block").alias("block2"), F.col("s").alias("y"), "native"), "key")
    met = met.where("x <> y and block = block2 and (own or native)").select("block", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    close = met.withColumn("distance", F.levenshtein("a", "b", radius)).where(F.col("distance").between(0, radius))
    return near.unionByName(close)
