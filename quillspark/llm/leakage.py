"""Problem 7: held-out evaluation texts inside the documents of a corpus.

Items and documents are brought to the same template form: numbers, names and units become typed placeholders.
Windows of five template words are hash-joined on the template and on the values of its slots, so a window of another
instance of the template meets nothing. Each pair of a document and an item's part keeps the places of the windows that
agree, and only pairs with at least two are aligned: along the diagonals of these places, and from one diagonal to the
next where the document has a word more or less. Words that differ, and words more or less, may be at most one in eight
over at least fifteen words (Chinese: 25 characters), and no slot in the stretch may hold another value of its type: a
number against another number, a name against another name make it another instance of the template, no leak. A word
of no type in a slot's place is an altered word like any other.

Instruction and question sentences that several items share are left out of the items. Items are taken in blocks of at
most ``BLOCK_WORDS`` words, so that what is broadcast is bounded; all documents are searched for every block.

Defined results: null, empty and blank texts hold no item. A document holds an item once, however often the
passage stands in it. Copies of a document each have their own rows. Texts are processed whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table

WINDOW = 5
WORDS, CHARACTERS, DIFFER = 15, 25, 8
#: Words of the items that are searched at once; their windows, words and names are broadcast (some 100 bytes a word).
BLOCK_WORDS = 500_000
#: What a slot with another value costs: more than any stretch may differ in.
OTHER_VALUE = 100
#: How far the document may be ahead or behind between two neighbouring diagonals.
REACH = 2

#: Words for units, as placeholders of one type.
UNITS = {"days", "years", "times", "percent", "miles", "pages", "crowns", "pieces", "families", "elders", "lots", "kinds", "examples", "km", "kg", "hours", "weeks", "months", "meters", "metres", "dollars", "euros"}
#: Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans("аеіјорсухѕԁһАВЕІЈКМНОРСТУХЅοναρΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeijopcyxsdhABEIJKMHOPCTYXSovapABEZHIKMNOPTYX")
_WORD = re.compile(r"[⺀-鿿豈-﫿]|[^\W_⺀-鿿豈-﫿]+")
_MARK = re.compile(r"(?m)^[ \t]*(?:(?:[>|¦»#*•]|[-–—](?=\s)|\d{1,2}[.)](?=\s))[ \t]*)+")
_INNER = re.compile(r"[-‐‑–'’](?<=[^\W\d_⺀-鿿].)(?=[^\W\d_⺀-鿿])")
_OTHER = re.compile("[Ͱ-ӿԀ-ԯ]")
_COMBINING = re.compile("[̀-ͯ]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+|(?<=[。？！])|\n+")


def tokens(text: str, lower: bool = False) -> list[str]:
    """Words and Chinese characters, without punctuation, blanks, line marks and letter forms; the case is kept
    unless `lower`."""
    flat = _MARK.sub("", text)
    if not flat.isascii():
        flat = _COMBINING.sub("", unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", flat)))
        if _OTHER.search(flat):
            flat = flat.translate(LOOKALIKES)
    flat = _INNER.sub("", flat)
    return _WORD.findall(flat.lower() if lower else flat)


def is_han(w: str) -> bool:
    return "⺀" <= w[0] <= "鿿"


def template(low: list[str], names: frozenset[str] | set[str]) -> list[str]:
    """The typed placeholders in place of numbers, names and units of lower-case words; all else as it is."""
    return ["<num>" if w.isdigit() else "<name>" if w in names else "<unit>" if w in UNITS else w for w in low]


def windows(low: list[str], form: list[str | None]) -> list[tuple[int, int, int]]:
    """(place, hash of the template, hash of the slots' values) of each window; `form`: the words' template, None for
    a word with which no window can meet anything."""
    out, run = [], 0
    for i, w in enumerate(form):
        run = run + 1 if w else 0
        if run >= WINDOW:
            a = i - WINDOW + 1
            slots = [low[k] for k in range(a, i + 1) if form[k][0] == "<"]
            out.append((a, _hash(form[a : i + 1]), _hash(slots) if slots else 0))
    return out


def _hash(words: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(words)) - (1 << 63)


def _sentences(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = []
        for no, text in zip(pdf["item_id"], pdf["text"], strict=True):
            for k, s in enumerate(_SENTENCE.split(text or "")):
                words = tokens(s)
                if words:
                    out.append((no, k, words, _hash([w.lower() for w in words])))
        yield pd.DataFrame(out, columns=["item_id", "k", "words", "h"])


def item_sentences(items: DataFrame) -> DataFrame:
    """item_id, k, words, shared: the sentences of the items; shared: a short one that stands in several items."""
    s = items.where("text is not null").select("item_id", "text").mapInPandas(_sentences, "item_id long, k int, words array<string>, h long")
    several = s.groupBy("h").agg((F.min("item_id") != F.max("item_id")).alias("several"))
    return s.join(several, "h").select("item_id", "k", "words", (F.col("several") & (F.size("words") < WORDS)).alias("shared"))


class Items:
    """A block of items: their parts between shared sentences, the names that stand in them, and their windows."""

    def __init__(self, rows: list[tuple[int, int, list[str], bool]]) -> None:
        self.parts: dict[tuple[int, int], list[str]] = {}
        capital: set[str] = set()
        parts: dict[int, list[list[str]]] = {}
        for i, _, words, shared in sorted(rows, key=lambda r: r[:2]):
            capital.update(x.lower() for x in words[1:] if x[:1].isupper() and len(x) > 2 and not x.isupper())
            own = parts.setdefault(i, [[]])
            if shared:
                own.append([])
            else:
                own[-1].extend(words)
        self.names = frozenset(capital)
        for i, own in parts.items():
            for k, p in enumerate(own):
                if p:
                    self.parts[i, k] = [w.lower() for w in p]
        #: The template's word for each word that an item has.
        self.known = {w: f for p in self.parts.values() for w, f in zip(p, template(p, self.names), strict=True)} | {n: "<name>" for n in self.names} | {u: "<unit>" for u in UNITS}

    def windows(self) -> list[tuple[int, int, int, int, int]]:
        return [(i, k, *w) for (i, k), p in self.parts.items() for w in windows(p, template(p, self.names))]


def _long_enough(costs: dict[int, list[int]], need: int, starts: Iterable[int] | None = None) -> bool:
    """Whether a stretch of at least `need` places differs in at most one in eight. `costs`: for each diagonal what
    each of the item's places costs on it; going on along a greater diagonal costs the words that the document has
    more, along a smaller one the item's words that it lacks; `starts`: places where a stretch may begin, or all."""
    n = len(next(iter(costs.values())))
    if len(costs) == 1:
        c = next(iter(costs.values()))
        total = [0]
        for x in c:
            total.append(total[-1] + x)
        return any((total[j] - total[i]) * DIFFER <= j - i for i in range(n - need + 1) if not c[i] for j in range(i + need, min(n, i + 2 * need) + 1))
    for i in range(n - need + 1) if starts is None else starts:
        at = {d: 0 for d, c in costs.items() if not c[i]}
        for j in range(i + 1, min(n, i + 2 * need)):
            if not at:
                break
            step = {}
            for d, c in costs.items():
                step[d] = min([at[d] + c[j]] if d in at else [2 * OTHER_VALUE], default=0)
                for e, x in at.items():
                    if e < d <= e + REACH:
                        step[d] = min(step[d], x + d - e + c[j])
                    elif e - REACH <= d < e and costs[e][j] < OTHER_VALUE:
                        step[d] = min(step[d], x + e - d)
            at = {d: x for d, x in step.items() if x * DIFFER <= 2 * need}
            if j + 1 - i >= need and any(x * DIFFER <= j + 1 - i for x in at.values()):
                return True
    return False


class Part:
    """A part of an item, prepared for comparisons. `ids`: numbers of the items' words."""

    def __init__(self, words: list[str], names: frozenset[str], ids: dict[str, int]) -> None:
        self.han = sum(map(is_han, words)) * 2 > len(words)
        self.form = template(words, names)
        if self.han:
            self.array = _codes("".join(words))
            self.starts = np.cumsum([0, *map(len, words)])
            self.slots = [(int(a), len(w)) for a, w in zip(self.starts, words, strict=False) if not is_han(w)]
        else:
            self.array = np.fromiter((ids[w] for w in words), "int64", len(words))


class Document:
    """The words of a document, for the comparison with parts of items. `ids`: numbers of the items' words."""

    def __init__(self, text: str, names: frozenset[str], ids: dict[str, int]) -> None:
        self.words = tokens(text)
        self.low = [w.lower() for w in self.words]
        self.names = names
        self.array = np.fromiter((ids.get(w, -1) for w in self.low), "int64", len(self.low))
        self.chars: str | None = None

    def _type(self, i: int) -> str:
        w = self.words[i]
        if w.isdigit():
            return "<num>"
        if self.low[i] in self.names:
            return "<name>"
        if self.low[i] in UNITS:
            return "<unit>"
        around = self.words[max(0, i - 3) : i + 4]
        return "<name>" if w[:1].isupper() and not w.isupper() and len(w) > 2 and sum(x[:1].isupper() for x in around) * 2 <= len(around) else ""

    def holds(self, part: Part, places: list[tuple[int, int]]) -> bool:
        """`places`: (place in the part, place in the document) of windows that agree."""
        if part.han:
            return self._holds_han(part, places)

        def costs(d: int, same: np.ndarray) -> list[int]:
            out = [0 if x else 1 for x in same]
            for i in np.flatnonzero(~same):
                if not 0 <= i + d < len(self.low) or part.form[i][0] == "<" and part.form[i] == self._type(i + d):
                    out[i] = OTHER_VALUE
            return out

        return len(part.array) >= WORDS and _near({b - a for a, b in places}, part.array, self.array, costs, WORDS)

    def _holds_han(self, part: Part, places: list[tuple[int, int]]) -> bool:
        """By characters: a foreign character may stand inside a name or number."""
        if len(part.array) < CHARACTERS:
            return False
        if self.chars is None:
            self.chars = "".join(self.low)
            self.codes = _codes(self.chars)
            self.starts = np.cumsum([0, *map(len, self.low)])

        def costs(d: int, same: np.ndarray) -> list[int]:
            out = [0 if x else 1 if 0 <= i + d < len(self.chars) else OTHER_VALUE for i, x in enumerate(same)]
            for a, n in part.slots:
                wrong = n - int(same[a : a + n].sum())
                if wrong and (wrong > 2 or not any(map(is_han, self.chars[max(0, a + d) : max(0, a + d + n)]))):
                    out[a] = OTHER_VALUE
            return out

        return _near({int(self.starts[b] - part.starts[a]) for a, b in places}, part.array, self.codes, costs, CHARACTERS)


def _codes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("utf-32-le"), "uint32").astype("int64")


def _near(diagonals: set[int], part: np.ndarray, doc: np.ndarray, costs: Callable, need: int) -> bool:
    """Diagonals that lie near each other, and their neighbours, where no window need be whole, are followed together;
    first a cheap test whether enough is the same."""
    n = len(part)

    def same(d: int) -> np.ndarray:
        out = np.zeros(n, bool)
        a, b = max(0, -d), min(n, len(doc) - d)
        if b > a:
            out[a:b] = part[a:b] == doc[a + d : b + d]
        return out

    def enough(s: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(s)))
        return np.flatnonzero(total[need:] - total[:-need] >= need - need // DIFFER - 1)

    group: dict[int, np.ndarray] = {}
    for d in [*sorted({e for d in diagonals for e in (d - 1, d, d + 1)}), None]:
        if group and (d is None or d - max(group) > REACH):
            starts = enough(np.logical_or.reduce(list(group.values())))
            if len(starts):
                alone = {k: costs(k, s) for k, s in group.items() if len(enough(s))}
                if any(_long_enough({k: c}, need) for k, c in alone.items()) or _long_enough({k: alone.get(k) or costs(k, s) for k, s in group.items()}, need, starts):
                    return True
            group = {}
        if d is not None:
            group[d] = same(d)
    return False


def _find_block(texts: DataFrame, held: Items) -> DataFrame:
    spark = texts.sparkSession
    rows = held.windows()
    shared = spark.sparkContext.broadcast((held.parts, held.names, held.known, frozenset(r[3] for r in rows)))  # bounded by the block's words

    def cut_windows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, _, known, thin = shared.value
        for pdf in it:
            out = []
            for no, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                low = tokens(text, lower=True)
                out += [(no, *w) for w in windows(low, [known.get(w) or (w.isdigit() and "<num>") for w in low]) if w[1] in thin]
            yield pd.DataFrame(out, columns=["doc_id", "at", "h", "slots"])

    def verify(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, names, known, _ = shared.value
        ids = {w: k for k, w in enumerate(known)}
        made: dict[tuple[int, int], Part] = {}
        for pdf in it:
            out = set()
            for no, text, pairs in zip(pdf["doc_id"], pdf["text"], pdf["pairs"], strict=True):
                doc = Document(text, names, ids)
                for p in pairs:
                    key = p["item_id"], p["part"]
                    if key not in made:
                        made[key] = Part(parts[key], names, ids)
                    if (no, key[0]) not in out and doc.holds(made[key], [(x["i"], x["at"]) for x in p["places"]]):
                        out.add((no, key[0]))
            yield pd.DataFrame(sorted(out), columns=["doc_id", "item_id"])

    w = spark.createDataFrame(pd.DataFrame(rows, columns=["item_id", "part", "i", "h", "slots"]), "item_id long, part int, i int, h long, slots long")
    met = texts.mapInPandas(cut_windows, "doc_id long, at int, h long, slots long").join(w, ["h", "slots"])
    # Fifteen words, or 25 Chinese characters, of which one in eight differs keep at least two windows whole.
    pairs = met.groupBy("doc_id", "item_id", "part").agg(F.collect_list(F.struct("i", "at")).alias("places")).where(F.size("places") >= 2)
    per = pairs.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "part", "places")).alias("pairs"))
    return texts.join(cut(per), "doc_id").mapInPandas(verify, "doc_id long, item_id long")


def find_leaks(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id of the documents (doc_id, text) that hold items (item_id, text)."""
    texts = docs.where("text is not null and text <> ''").select("doc_id", "text")
    sentences = cut(item_sentences(items))
    words = sentences.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-words // block_words) or 1
    out = None
    for b in range(n):
        rows = sentences.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect()  # some `block_words` words
        if rows:
            x = _find_block(texts, Items([(r["item_id"], r["k"], r["words"], r["shared"]) for r in rows]))
            out = x if out is None else out.unionByName(x)
    return out if out is not None else texts.sparkSession.createDataFrame([], "doc_id long, item_id long")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold evaluation items, with the items."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, documents: the number of documents that hold each leaked item."""
    return p7_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))


QUERIES = {"p7_found": p7_found, "p7_leaked_items": p7_leaked_items}
