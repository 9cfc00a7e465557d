"""Per-document text quality: statistics, and kinds of text told apart by boosted trees over such statistics."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import trees

KINDS = ("prose", "list", "table", "junk")
#: Words are runs of one script: ideographs, hiragana, katakana, or Latin letters and digits.
WORD = r"[\x{3400}-\x{9FFF}\x{3005}]+|[\x{3041}-\x{309F}]+|[\x{30A1}-\x{30FF}]+|[A-Za-z0-9\x{00C0}-\x{024F}]+"
LETTERS = r"[\x{3400}-\x{9FFF}\x{3005}\x{3041}-\x{309F}\x{30A1}-\x{30FF}A-Za-z0-9\x{00C0}-\x{024F}]"
BLANKS = r"[ \t\n\r\x{3000}]"
END = r"[。．.!?！？」』)）]$"
#: A word is common if at least this share of all documents holds it.
COMMON = 0.01
#: Documents that may be weakly labelled for training, and hand-labelled documents used at most.
WEAK_SAMPLE, HAND_SAMPLE = 5000, 6000


def common_words(docs: DataFrame, text: str = "text", share: float = COMMON) -> list[str]:
    """Words of at least `share` of all documents, by counts over the whole corpus. There are at most (mean number of
    different words of a document) / share of them, however large the corpus."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)))).alias("word"))
    n = docs.count()
    return sorted(r.word for r in words.groupBy("word").count().where(F.col("count") >= share * n).toLocalIterator())


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = COMMON) -> DataFrame:
    """doc_id, n_words, mean_word_length, symbol_share, line_end_share and common_word_share of every row.

    Null and empty texts have 0 of everything. Repeated rows each come out; other columns are ignored.
    """
    common = common_words(docs, text, share)
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))
    df = docs.select(F.col(doc_id).alias("doc_id"), words.alias("words"), *(c.alias(name) for name, c in measures(F.col(text)).items()))
    return df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _ratio(F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w)), F.size("words")).alias("mean_word_length"),
        "symbol_share",
        "line_end_share",
        _ratio(F.size(F.filter("words", lambda w: w.isin(common))) if common else F.lit(0), F.size("words")).alias("common_word_share"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def measures(text: Column) -> dict[str, Column]:
    """Statistics that need nothing but the text: symbol_share and line_end_share."""
    t = F.coalesce(text, F.lit(""))
    dense = F.length(F.regexp_replace(t, f"{BLANKS}+", ""))
    symbols = F.length(F.regexp_replace(t, f"[{BLANKS[1:-1]}{LETTERS[1:-1]}]+", ""))
    lines = F.regexp_count(t, F.lit(rf"(?m)^[ \t\r\x{{3000}}]*[^ \t\r\n\x{{3000}}]"))
    ended = F.regexp_count(t, F.lit(END[:-1] + r"[ \t\r\x{3000}]*(?:\n|\z)"))
    return {"symbol_share": _ratio(symbols, dense), "line_end_share": _ratio(ended, lines)}


_WORDS = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), WORD))
_MARK = re.compile(r"\s*(?:[-*+•・※→☐■□○●◎▪◦‣–—>]+\s*(?:\[[ xX]?\]\s*)?|(?:No\.|§|第)?\s*[(（\[]?\d{1,3}[.)）\]:、．]\s*|No\.\d+\s|[(（]\w{1,4}[)）]\s*|(?:[a-zA-Z]|[ivxIVX]{1,4}|[ア-ン]|[一二三四五六七八九十]{1,2})[ .)、．]\s*)(?=\S)")
_ENDS = tuple("。．.!?！？」』")
#: What separates columns: a sign that every separation holds, and its pattern where the sign alone is not enough.
_FIELD = {"tab": ("\t", None), "bar": ("|", None), "comma": (",", re.compile(r",(?! )")), "ideographic comma": ("、", re.compile(r"、(?=\S{0,12}、)")), "semi": (";", None), "gap": ("  ", re.compile(r"(?<=\S) {2,}(?=\S)")), "colon": (":", re.compile(r": ")), "wide colon": ("：", re.compile(r"： "))}
_SUMMED = {"comma": "ideographic comma", "colon": "wide colon"}
_SENTENCE, _RUN = re.compile("[。．.!?！？\n]"), re.compile(r"(\S)\1{3,}")
_NO_VOWELS = str.maketrans("", "", "aeiouyAEIOUYāēīōū")
FEATURES = 42


_SORTS = ("space", "hira", "kata", "kanji", "digit", "capital", "latin", "half", "odd")


def _sort(o: int) -> int:
    """What a character is, as a place in _SORTS; capitals are Latin ones."""
    c = chr(o)
    if c.isspace():
        return 0
    if 0x3041 <= o <= 0x309F:
        return 1
    if 0x30A1 <= o <= 0x30FF:
        return 2
    if 0x3400 <= o <= 0x9FFF or o == 0x3005:
        return 3
    if c.isdigit():
        return 4
    if o < 0x250 and c.isalpha():
        return 5 if c.isupper() else 6
    return 7 if 0xFF61 <= o <= 0xFF9F or o == 0xFFFD else 8


@lru_cache(1)
def _sorts() -> np.ndarray:
    """_sort() of the basic plane; what lies beyond is odd."""
    return np.array([_sort(o) for o in range(0x10000)] + [8], np.uint8)


def _columns(text: str, lines: list[str]) -> dict[str, Counter]:
    """For each separator the numbers of lines by how often it occurs in them."""
    found = {}
    for name, (sign, pattern) in _FIELD.items():
        per = [0] * len(lines) if sign not in text else [len(pattern.findall(x)) if sign in x else 0 for x in lines] if pattern else [x.count(sign) for x in lines]
        found[name] = per
    for name, other in _SUMMED.items():
        more = found.pop(other)
        found[name] = [a + b for a, b in zip(found[name], more)]
    return {name: Counter(per) for name, per in found.items()}


def features(text: str | None, common: frozenset[str]) -> list[float]:
    """Numbers that describe the whole of `text`."""
    text = text or ""
    lines = [x for x in text.split("\n") if x.strip()]
    n, k = len(text), max(1, len(lines))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space, hira, kata, kanji, digit, capitals, small, half, odd = np.bincount(_sorts()[np.minimum(codes, 0x10000)], minlength=len(_SORTS)).tolist()
    latin, dense = capitals + small, max(1, n - space)
    sizes = [len(x) for x in lines] or [0]
    longest, mean = max(sizes), sum(sizes) / k
    spread = (sum([(s - mean) ** 2 for s in sizes]) / k) ** 0.5
    marked = [bool(_MARK.match(x)) for x in lines]
    ended = sum([x.rstrip().endswith(_ENDS) for x in lines])
    heads = Counter([x.lstrip()[:1] for x in lines])
    columns = _columns(text, lines)
    fields = [max((m for c, m in columns[name].items() if c), default=0) / k for name in ("tab", "bar", "comma", "semi", "gap", "colon")]
    several = [columns[name] for name in ("tab", "bar", "comma", "semi", "gap")]
    table = max(max((m for c, m in per.items() if c >= 2), default=0) / k for per in several)
    two = max(max((m for c, m in per.items() if c >= 1), default=0) / k for per in several)
    words = _WORDS.findall(text)
    w = max(1, len(words))
    pieces = text.split()
    p = max(1, len(pieces))
    top = Counter(pieces).most_common(1)
    sentences = [s.strip() for s in _SENTENCE.split(text) if s.strip()]
    s = max(1, len(sentences))
    roman = [x for x in words if x[0] < "ɐ" and x[0].isalpha()]
    r, letters = max(1, len(roman)), "".join(roman)
    vowels = 1 - len(letters.translate(_NO_VOWELS)) / len(letters) if letters else 0.0
    raw = text.encode("utf-8", "replace")
    run = max([m.end() - m.start() for m in _RUN.finditer(text)], default=0)
    mixed = sum([any(c.isdigit() for c in x) and any(c.isupper() for c in x) and any(c.islower() for c in x) for x in pieces if len(x) > 11]) if digit and capitals else 0
    full = sum([x >= 0.8 * longest for x in sizes])
    return [
        n, len(lines), mean, spread / max(1, mean), longest,
        hira / dense, kata / dense, kanji / dense, latin / dense, digit / dense, odd / dense, half / dense,
        sum(marked) / k, ended / k, sum(marked[1:]) / max(1, k - 1), max(heads.values(), default=0) / k,
        *fields, table, two, len(words) / dense, sum(map(len, words)) / w, sum([x in common for x in words]) / w,
        len(set(words)) / w, p / dense, top[0][1] / p if p > 4 else 0, sum([len(x) <= 2 for x in pieces]) / p,
        len(set(sentences)) / s, sum(map(len, sentences)) / s, s / k,
        vowels, sum([len(x) > 15 for x in roman]) / r, mixed / p, len(zlib.compress(raw, 1)) / max(20, len(raw)),
        run / dense, len(set(text)) / dense**0.5, full / k, capitals / max(1, latin),
    ]


def weak_kind(x: list[float]) -> str | None:
    """A kind where a coarse rule over the statistics is sure of it."""
    (n, lines, mean, _, _, hira, _, kanji, latin, _, odd, half, marked, ended, _, _, *_), table, common = x, x[22], x[26]
    if n == 0 or half > 0.15 or odd > 0.7 or x[29] > 0.5 or x[38] > 0.3 or x[36] > 0.5:
        return "junk"
    if lines >= 3 and table >= 0.85 and marked < 0.5:
        return "table"
    if lines >= 3 and marked >= 0.85 and table < 0.3:
        return "list"
    if marked < 0.1 and table < 0.1 and ended > 0.6 and mean > 25 and (hira > 0.3 or latin > 0.6 and common > 0.4) and x[30] < 0.6:
        return "prose"
    return None


def train(docs: DataFrame, labels: DataFrame, common: list[str], weak_sample: int = WEAK_SAMPLE, hand_sample: int = HAND_SAMPLE) -> trees.Forest:
    """Trees fitted on weakly labelled documents and half of the hand labels, calibrated on the other half.

    Both samples are bounded and drawn by the hash of the id; of several hand labels of a document the most frequent
    counts, and documents without a majority are left out. Only this fitting is sampled; scoring covers every document. The
    statistics are computed where the texts are; the driver sees numbers only.
    """
    words = frozenset(common)
    votes = labels.where(F.col("kind").isin(*KINDS)).groupBy("doc_id", "kind").count()
    most = votes.groupBy("doc_id").agg(F.max(F.struct("count", "kind")).alias("best"), F.sum("count").alias("all")).where("2 * best.count > all")
    rows = docs.select("doc_id", F.xxhash64("doc_id").alias("h"))
    hand = rows.join(most.select("doc_id", F.col("best.kind").alias("kind")), "doc_id").orderBy("h", "doc_id").limit(hand_sample)
    weak = rows.join(most.select("doc_id"), "doc_id", "left_anti").orderBy("h", "doc_id").limit(weak_sample).withColumn("kind", F.lit(None).cast("string"))
    drawn = docs.join(F.broadcast(hand.unionByName(weak)), "doc_id").select("h", "kind", "text")  # at most both samples' ids

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"h": pdf["h"], "kind": pdf["kind"], "x": [features(t, words) for t in pdf["text"]]})

    x, y, weight, held, truth, unsure = [], [], [], [], [], []
    for row in sorted(drawn.mapInPandas(shapes, "h long, kind string, x array<double>").toLocalIterator(), key=lambda r: (r.h, r.kind or "", r.x)):
        if row.kind is None:
            unsure.append(row.x)
        else:
            (held if row.h % 2 else x).append(row.x)
            (truth if row.h % 2 else y).append(KINDS.index(row.kind))
    weight = [2.0] * len(y)
    for f in unsure:
        if kind := weak_kind(f):
            x.append(f)
            y.append(KINDS.index(kind))
            weight.append(0.5 if len(truth) > 200 else 1.0)
    if not x:
        x, y, weight = [features("", words)], [KINDS.index("junk")], [1.0]
    forest = trees.fit(np.array(x, float), np.array(y), np.array(weight), len(KINDS))
    return trees.calibrate(forest, np.array(held, float).reshape(-1, FEATURES), np.array(truth, int))


def kinds(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, kind and the calibrated probability of each kind for every document.

    Null, empty and blank texts are junk. Repeated rows each come out.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "kind")
    common = common_words(docs)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((train(docs, labels, common, **options), frozenset(common)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, words = sent.value
        for pdf in batches:
            x = np.array([features(t, words) for t in pdf.text], float).reshape(-1, FEATURES)
            p = forest.probability(x) if len(x) else np.zeros((0, len(KINDS)))
            blank = np.array([not (t or "").strip() for t in pdf.text], bool)
            p[blank] = np.eye(len(KINDS))[KINDS.index("junk")]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "kind": [KINDS[i] for i in p.argmax(axis=1)], **{f"p_{kind}": p[:, i] for i, kind in enumerate(KINDS)}})

    # ids travel as text, so that a null among them does not make them numbers with a fraction
    scored = docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(score, f"doc_id string, kind string, {', '.join(f'p_{k} double' for k in KINDS)}")
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))
