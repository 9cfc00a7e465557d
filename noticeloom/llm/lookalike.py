"""Visually identical text with different characters.

The vocabulary of the corpus is gathered as it is written. Of the spellings that look alike, the most frequent one whose
own signs agree is canonical; canonical spellings become tries, and every doubtful word runs through them with a weighted
automaton. Other widths, split marks, invisible signs and look-alikes of other scripts are free, a digit for a letter
costs half, anything else more than the budget. Words that no canonical spelling accepts are normalised by table: stand-ins
that are certain wherever they occur, such as other widths and split marks, and look-alikes by the scripts around them.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import BROADCAST_BYTES, Scratch, apart, estimated_bytes

# Pairs of signs that look the same, other script first.
LATIN = dict(zip("аеорсухіјѕһԁԛԝкАВЕКМНОРСТХУЅІЈΑΒΕΖΗΙΚΜΝΟΡΤΥΧονα", "aeopcyxijshdqwkABEKMHOPCTXYSIJABEZHIKMNOPTYXova"))
KANA = dict(zip("カエロハニタトーチオヌヘ", "力工口八二夕卜一千才又へ"))
DASHES = dict.fromkeys("‐‑−", "-")
#: Digits and the letters that look nearly like them.
NEAR = {"0": "Oo", "1": "lIi"}
#: What a near look-alike and what any other edit costs, and what a word may cost altogether.
NEAR_COST, OTHER_COST, BUDGET = 0.5, 2.0, 1.0
#: A word written wholly in another script, or with a digit in it, gives way to a look-alike only if that is so many times as frequent.
WHOLE_WORD = 20
#: Words and canonical spellings held by one task.
BUCKET_WORDS = 40_000

_BACK = {v: k for k, v in KANA.items()}


class Signs:
    """Which signs look the same. `latin`: signs of other scripts and the Latin letters they look like."""

    def __init__(self, more: dict[str, str] | None = None) -> None:
        self.latin = {**(more or {}), **LATIN}
        self.look = {**self.latin, **KANA}
        self.same: dict[str, str] = {}
        for c, v in self.look.items():
            self.same[v] = self.same.get(v, "") + c
        doubtful = {*self.look, *self.look.values()} - set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
        self.doubt = re.compile("[" + re.escape("".join(sorted(doubtful))) + r"]|(?<=[A-Za-z])[01](?=[A-Za-z])")

    def shown(self, word: str) -> str:
        """What `word` looks like; equal for words that differ by look-alikes only."""
        return "".join(self.look.get(c, c) for c in word)

    def roughly(self, word: str) -> str:
        """As shown(), with near look-alikes taken as one."""
        return "".join(_ROUGH.get(c, c) for c in self.shown(word))


_ROUGH = {c: digit for digit, letters in NEAR.items() for c in letters}


def public_signs(spark) -> Signs:
    """The signs above and, of all letters of other scripts, those that the public table of confusable characters shows as
    one Latin letter. The table comes with the Unicode library of the session; without it the signs above stand alone."""
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        letters = [c for c in map(chr, range(0x370, 0x2C00)) if unicodedata.category(c) in ("Ll", "Lu", "Lo", "Lt") and not unicodedata.name(c, "").startswith("LATIN") and not unicodedata.decomposition(c)]
        plain = [c for c in map(chr, range(0x41, 0x7B)) if c.isalpha()]
        shapes = checker.getSkeleton(0, "\n".join([*plain, *letters])).split("\n")
    except TypeError:  # what is not there is a package, which cannot be called
        return Signs()
    by_shape: dict[str, str] = {}
    for c, shape in zip(plain, shapes):
        by_shape.setdefault((shape, c.isupper()) if len(shape) == 1 else (shape, None), c)
    more = {c: by_shape[shape, c.isupper()] for c, shape in zip(letters, shapes[len(plain) :]) if (shape, c.isupper()) in by_shape}
    return Signs(more)


_SIGNS = Signs()


def _invisible(c: str) -> bool:
    o = ord(c)
    return unicodedata.category(c) == "Cf" or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x34F, 0x115F, 0x1160, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0)


@lru_cache(1)
def _folds() -> tuple[dict[int, str], frozenset[str]]:
    """The table of signs that are stand-ins everywhere, by rule from the Unicode database, and the signs that call for folding."""
    table = {ord(c): v for c, v in DASHES.items()}
    for o in (*range(0x80, 0x34000), *range(0xE0000, 0xE1000)):  # beyond are unassigned and private signs
        c = chr(o)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs"):
            continue
        if _invisible(c):
            table[o] = ""
        elif kind == "Zs":
            table[o] = " "
        elif (parts := unicodedata.decomposition(c)) and not 0x1100 <= o < 0x1200:
            tag, single = parts.split()[0], len(parts.split()) - parts.startswith("<") == 1
            if single and (tag in ("<wide>", "<narrow>", "<font>") or tag == "<compat>" and 0x2E80 <= o <= 0x2FDF or not tag.startswith("<")):
                table[o] = unicodedata.normalize("NFKC", c)
    table |= {0xFF9E: "゙", 0xFF9F: "゚"}
    marks = {chr(o) for o in (*range(0x300, 0x370), *range(0x3099, 0x309D))}
    return table, frozenset(map(chr, table)) | marks


def fold(text: str) -> str:
    """`text` with every certain stand-in replaced; equal to `text` exactly if it holds none."""
    table, signs = _folds()
    if text.isascii() or signs.isdisjoint(text):
        return text
    text = re.sub("([か-ほカ-ホうウ])([゛゜])", lambda m: m[1] + chr(ord(m[2]) - 2), text.translate(table))
    return unicodedata.normalize("NFC", text)


@lru_cache(1)
def _word() -> tuple[re.Pattern, re.Pattern]:
    """Words as they are written, with split marks and invisible signs, and the units of a word: a sign and its marks."""
    apart = re.escape("".join(sorted({*map(chr, (*range(0x300, 0x370), *range(0x3099, 0x309D), 0xFF9E, 0xFF9F))} | {c for c in map(chr, _folds()[0]) if _invisible(c)})))
    latin = "A-Za-zＡ-Ｚａ-ｚ"
    letter, inner = rf"(?![{apart}])[^\W\d_]", rf"(?<=[{latin}{apart}])[01](?=[{apart}]*[{latin}])"
    more = rf"(?:[^\W\d_]|[{apart}]|{inner})*"
    return re.compile(rf"(?:{letter}|{inner}){more}(?:['’]{letter}{more})*"), re.compile(rf"[{apart}]*(?:(?![{apart}]).)[{apart}]*", re.DOTALL)


def words_of(text: str) -> list[str]:
    """The words of a text as they are written, repeated ones as often as they occur."""
    return _word()[0].findall(text)


def _script(c: str) -> str:
    if "ァ" <= c <= "ヺ":
        return "kata"
    return "kanji" if "㐀" <= c <= "鿿" or c in "々〆" else "other"


def by_table(word: str, signs: Signs = _SIGNS) -> str:
    """The spelling of a word judged by its own signs: letters from elsewhere within a Latin word, katakana among
    ideographs, ideographs inside katakana. A word wholly in one script stays as it is."""
    if not word.isascii() and any("a" <= c.lower() <= "z" for c in word):
        word = "".join(signs.latin.get(c, c) for c in word)
    out, i = list(word), 0
    while i < len(word):
        j = i
        while j < len(word) and (word[j] in KANA or word[j] in _BACK or _script(word[j]) == "kata"):
            j += 1
        run = word[i:j]
        kata = any(_script(c) == "kata" and c not in KANA for c in run)
        for k, c in enumerate(run, i):
            inside = k > 0 and (k > i or i == 0) or k == 0
            if kata and c in _BACK and inside and (k + 1 < j or k + 1 == len(word)):
                out[k] = _BACK[c]
            elif not kata and c in KANA and any(_script(x) == "kanji" and x not in _BACK for x in word):
                out[k] = KANA[c]
        i = max(j, i + 1)
    return "".join(out)


class Trie:
    """Canonical spellings with their counts."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, count: int) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = (count, word)

    def search(self, word: str, budget: float = 0.0, other: float = 1.0, signs: Signs = _SIGNS) -> tuple[float, int, str] | None:
        """(cost, -count, spelling) of the cheapest, then most frequent spelling within `budget`: equal signs, other widths,
        split marks, look-alikes and ignorables cost nothing, a digit for a letter like it NEAR_COST, other substitutions,
        insertions and deletions `other` each."""
        states = {id(self.root): (0.0, self.root)}

        def reach(states: dict, node: dict, cost: float) -> bool:
            """Whether a state is new or cheaper than before."""
            if cost <= budget and (id(node) not in states or states[id(node)][0] > cost):
                states[id(node)] = (cost, node)
                return True
            return False

        def skipped(states: dict) -> dict:
            todo = list(states.values()) if other <= budget else []
            while todo:
                cost, node = todo.pop()
                todo += [states[id(child)] for c, child in node.items() if c and reach(states, child, cost + other)]
            return states

        states = skipped(states)
        for c in (x for unit in _word()[1].findall(word) for x in fold(unit)):
            after: dict = {}
            shown = signs.look.get(c, c)
            alike = {c, shown, *signs.same.get(shown, "")}
            nearly = {*NEAR.get(shown, ""), _ROUGH.get(shown, shown)} - alike
            for cost, node in states.values():
                for x in alike:
                    if x in node:
                        reach(after, node[x], cost)
                if cost + NEAR_COST <= budget:
                    for x in nearly:
                        if x in node:
                            reach(after, node[x], cost + NEAR_COST)
                if cost + other <= budget:
                    reach(after, node, cost + other)
                    for x, child in node.items():
                        if x and x not in alike:
                            reach(after, child, cost + other)
            states = skipped(after)
            if not states:
                return None
        ends = [(cost, -node[""][0], node[""][1]) for cost, node in states.values() if "" in node]
        return min(ends, default=None)


def _sound(word: str, signs: Signs) -> bool:
    """Whether a word's own signs agree."""
    return fold(word) == word and by_table(word, signs) == word and not re.search("[A-Za-z][01]", word)


def _matcher(signs: Signs):
    def match(words: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
        trie, out = Trie(), []
        for w, n in zip(vocabulary.canonical, vocabulary.canonical_n):
            trie.add(w, int(n))
        for w, n in zip(words.word, words.n):
            hit, folded = trie.search(w, BUDGET, OTHER_COST, signs), fold(w)
            best = hit[2] if hit else folded
            own = all(c in signs.latin or ord(c) > 0x370 for c in folded) and any(c in signs.latin for c in folded)  # a word of its own script
            if hit and best != folded and (own or hit[0]) and -hit[1] < WHOLE_WORD * n:
                best = folded
            if best == folded:
                best = by_table(folded, signs)
            if best != folded:
                out.append((w, best))
        return pd.DataFrame(out, columns=["word", "canonical"])

    return match


def replacements(texts: DataFrame, scratch: Scratch, signs: Signs = _SIGNS) -> DataFrame:
    """word, canonical for the doubtful words of the column `text`, as they are written, whose canonical spelling the table
    of certain stand-ins does not give by itself. A canonical spelling is one whose own signs agree, of these the most
    frequent, then the smallest."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(1 << 17)
        def told(word: str) -> tuple[str, str, bool, bool]:
            folded = fold(word)
            return signs.shown(folded), signs.roughly(folded), _sound(word, signs), folded != word or bool(signs.doubt.search(folded))

        for pdf in batches:
            found: Counter = Counter()
            for text in pdf.text:
                if text:
                    found.update(set(words_of(text)))
            rows = [(w, n, *told(w)) for w, n in found.items()]
            yield pd.DataFrame(rows, columns=["word", "n", "look", "rough", "sound", "doubt"])

    counted = texts.select("text").mapInPandas(count, "word string, n long, look string, rough string, sound boolean, doubt boolean")
    counted = scratch.keep(counted.groupBy("word", "look", "rough", "sound", "doubt").agg(F.sum("n").alias("n")))
    doubtful = counted.where("doubt")
    alike = counted.where("sound").join(doubtful.select("rough").distinct(), "rough", "left_semi")
    chosen = alike.groupBy("rough", "look").agg(F.min(F.struct(-F.col("n"), "word")).alias("best")).select("rough", F.col("best.word").alias("canonical"), (-F.col("best.col1")).alias("canonical_n"))
    buckets = max(1, -(-doubtful.count() // BUCKET_WORDS))
    bucket = F.pmod(F.xxhash64("rough"), F.lit(buckets)).cast("int").alias("bucket")
    left = doubtful.select("word", "n", bucket).groupBy("bucket")
    right = chosen.select("canonical", "canonical_n", bucket).groupBy("bucket")
    return scratch.keep(left.cogroup(right).applyInPandas(_matcher(signs), "word string, canonical string"))


def rewritten(text: str, by: dict[str, str]) -> str:
    """`text` with its words replaced and every certain stand-in folded."""
    return fold(_word()[0].sub(lambda m: by.get(m[0], m[0]), text) if by and not text.isascii() or _NUMBERED.search(text) else text)


_NUMBERED = re.compile("[A-Za-z][01]+[A-Za-z]")


def unified(texts: DataFrame, text: str = "text") -> DataFrame:
    """All rows of `texts` with `canonical`, the text in its one form, and `stand_in`, whether it held a stand-in.

    Null stays null and holds none; other columns are kept, ones named canonical or stand_in with _in. Repeated rows each
    come out. Whole texts are used, and the vocabulary is that of all rows. Where all replaced words are within the size for
    broadcasts, each text is read once more and nothing is shuffled; otherwise texts meet their words by a digest.
    """
    spark, scratch = texts.sparkSession, Scratch(texts.sparkSession)
    signs = public_signs(spark)
    names = dict(zip(texts.columns, apart(texts, ["canonical", "stand_in"]).columns))
    texts, text = texts.toDF(*names.values()), names[text]
    words = replacements(texts.select(F.col(text).alias("text")), scratch, signs)
    rows = texts.select(F.struct("*").alias("row"), F.col(text).alias("__text"))
    if estimated_bytes(words) <= BROADCAST_BYTES:
        sent = spark.sparkContext.broadcast({r.word: r.canonical for r in words.toLocalIterator()})

        @F.pandas_udf("string")
        def one_form(values: pd.Series) -> pd.Series:
            return values.map(lambda t: None if t is None else rewritten(t, sent.value))

        out, canonical = rows.withColumn("__c", one_form("__text")), F.col("__c")
    else:
        out = _met(rows.withColumn("__digest", F.md5("__text")).withColumn("__folded", _fold_udf()("__text")), words, scratch, signs)
        canonical = F.coalesce("__c", "__folded")
    return out.select("row.*", canonical.alias("canonical"), (F.col("__text").isNotNull() & (canonical != F.col("__text"))).alias("stand_in"))


def _met(rows: DataFrame, words: DataFrame, scratch: Scratch, signs: Signs) -> DataFrame:
    """`rows` with __c, the rewritten text of those that hold a replaced word; few do, and only they meet their words."""

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(d, w) for d, t in zip(pdf.digest, pdf.text) if t for w in set(words_of(t)) if fold(w) != w or signs.doubt.search(w)], columns=["digest", "word"])

    def replaced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"digest": pdf.digest, "canonical": [rewritten(t, dict(p)) for t, p in zip(pdf.text, pdf.pairs)]})

    different = rows.where("__text is not null").groupBy(F.col("__digest").alias("digest")).agg(F.first("__text").alias("text"))
    different = scratch.keep(different)
    pairs = different.mapInPandas(needed, "digest string, word string").join(words, "word").groupBy("digest").agg(F.collect_set(F.array("word", "canonical")).alias("pairs"))
    changed = scratch.keep(different.join(pairs, "digest").mapInPandas(replaced, "digest string, canonical string"))
    return rows.join(changed.select(F.col("digest").alias("__digest"), F.col("canonical").alias("__c")), "__digest", "left")


def _fold_udf():
    @F.pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else fold(t))

    return folded
