"""Problem 4: text that was decoded with the wrong character encoding.

Every distinct clean word of the corpus is garbled under every chain of encodings; the distinct tokens of the
texts are hash-joined with that table, and the originals that the table gives are verified by undoing the chain
over the whole token. Words are: Latin words with a letter outside ASCII, pairs of neighbouring Chinese
characters, and single characters outside ASCII (quotes, dashes, emoji, letters). A text without blanks between
words is met by its n-grams, of the lengths that garbled words have.

Everything is keyed by distinct tokens, which are pre-aggregated on the map side, so a token that stands in a
third of all rows is handled once; the rows meet their garbled tokens in one join on the token.

Defined results: null, empty and plain ASCII texts are clean. A token with U+FFFD or a C1 control character is
garbled whether or not it can be restored. Repeated rows count each on their own. Texts of any length are
handled; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table

#: (tbl, row key, field) of the fields that may be garbled.
FIELDS = [("message_data", "msg_no", "page_content"), ("chat_messages", "chat_no", "page_content"), ("chat_messages", "chat_no", "sender_name"), ("meta_posts", "post_no", "page_content")]

#: The chains, each (right encoding, wrong encoding, times).
CHAINS = [
    ("utf-8", "latin-1", 1), ("utf-8", "cp1252", 1), ("utf-8", "latin-1", 2), ("utf-8", "cp1252", 2), ("utf-8", "cp437", 1), ("utf-8", "cp850", 1),
    ("utf-8", "mac-roman", 1), ("utf-8", "cp1251", 1), ("utf-8", "cp1250", 1), ("utf-8", "gbk", 1), ("utf-8", "cp932", 1), ("utf-8", "big5", 1),
    ("utf-8", "cp950", 1), ("big5", "latin-1", 1), ("big5", "cp1252", 1), ("big5", "gbk", 1), ("gbk", "latin-1", 1), ("cp437", "cp1252", 1), ("cp437", "latin-1", 1),
    ("cp850", "cp1252", 1), ("cp850", "latin-1", 1), ("mac-roman", "cp1252", 1), ("cp1252", "mac-roman", 1), ("cp1252", "cp437", 1), ("cp1252", "cp850", 1), ("utf-8", "euc-kr", 1),
]
WIDE = {"gbk", "cp932", "big5", "cp950", "euc-kr", "utf-8"}


def _table(codec: str) -> tuple[dict, dict]:
    """Bytes to characters of a one-byte encoding and back; bytes without a character stand for themselves."""
    to = {}
    for b in range(256):
        try:
            to[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            to[b] = chr(b)
    return to, {c: b for b, c in to.items()}


_TABLES = {c: _table(c) for pair in CHAINS for c in pair[:2] if c not in WIDE}


def decode(data: bytes, codec: str) -> str:
    if codec in WIDE:
        return data.decode(codec, "replace")
    to = _TABLES[codec][0]
    return "".join([to[b] for b in data])


def encode(text: str, codec: str) -> bytes | None:
    if codec in WIDE:
        try:
            return text.encode(codec)
        except UnicodeEncodeError:
            return None
    back = _TABLES[codec][1]
    data = [back.get(c) for c in text]
    return None if None in data else bytes(data)


def garble(text: str, chain: tuple[str, str, int]) -> str | None:
    right, wrong, times = chain
    for _ in range(times):
        data = encode(text, right)
        if data is None:
            return None
        text = decode(data, wrong)
    return text


def undo(text: str, chain: tuple[str, str, int]) -> str | None:
    right, wrong, times = chain
    for _ in range(times):
        data = encode(text, wrong)
        if data is None:
            return None
        try:
            text = data.decode(right)
        except UnicodeDecodeError:
            return None
    return text


#: Letters of clean Latin words; blanks split tokens, and so do Chinese punctuation marks.
_LATIN = "A-Za-zÀ-ÖØ-öø-žſƀ-ɏḀ-ỿ"
_CJK = "一-鿿"
_SPLIT = r"[ \t\r\n\x0b\x0c　。，、？！：；「」『』（）]+"
_EDGE = r"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$"
#: Letters that seldom stand in words but often in garbled ones, and what separates the words of a token.
_MARKS = "[ÃÂĂ‚„”™š‡ˆ‰ŠŒŽ]|[ÄÅ][‘’“–—…]"
_BREAK = re.compile(r"[\x00-\x26\x28-\x2c\x2e-\x40\x5b-\x60\x7b-\x7f“”„«»…–—]+").split
_SURE = r"[\u0080-\u0084\u0086-\u009f�]"


def field_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, field_name, token: the tokens with a character outside ASCII."""
    out = None
    for tbl, key, field in FIELDS:
        x = table(spark, sf_dir, tbl).where(F.col(field).rlike(r"[^\x00-\x7f]"))
        x = x.select(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id"), F.lit(field).alias("field_name"), F.explode(tokens(F.col(field))).alias("token"))
        out = x if out is None else out.unionByName(x)
    return out


def tokens(text: Column) -> Column:
    beyond = F.filter(F.split(text, _SPLIT), lambda t: t.rlike(r"[^\x00-\x7f]"))
    return F.array_distinct(F.transform(F.array_distinct(beyond), lambda t: F.regexp_replace(t, _EDGE, "")))


def clean_words(distinct: DataFrame) -> DataFrame:
    """word, n: distinct clean words of the corpus with the number of tokens' rows they stand in."""
    d = distinct.where(~F.col("token").rlike(_SURE))
    latin = d.where(F.col("token").rlike(f"^[{_LATIN}’'-]+$")).select(F.col("token").alias("word"), "n")
    pairs = d.where(F.col("token").rlike(f"[{_CJK}]{{2}}")).select(F.explode(F.expr("transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))")).alias("word"), "n").where(F.col("word").rlike(f"^[{_CJK}]{{2}}$"))
    # Single characters: letters beside Latin letters, Chinese characters, and marks and emoji that stand free.
    single = d.select(F.explode(F.array_distinct(F.regexp_extract_all("token", F.lit(r"([^\x00-\x7f]\ufe0f?)"), F.lit(1)))).alias("word"), "n")
    return latin.unionByName(pairs).unionByName(single).groupBy("word").agg(F.sum("n").alias("n"))


def _sliced(it: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in smaller frames: what a row is expanded to stays small in a worker's memory."""
    for pdf in it:
        for i in range(0, len(pdf), rows):
            yield pdf.iloc[i : i + rows]


def _forms(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in _sliced(it, 500):
        out = []
        for word, n in zip(pdf["word"], pdf["n"], strict=True):
            for k, chain in enumerate(CHAINS):
                g = garble(word, chain)
                # A form must show that it is one: longer than the word or with characters no word has.
                if g and g != word and "�" not in g and g.strip(" \t\r\n") == g and len(g) >= 2:
                    if len(word) == 1 and (chain[1] in WIDE and len(g) < 3 and not "｡" <= g[0] <= "ﾟ" or chain[0] != "utf-8"):
                        continue
                    out.append((g, word, n, k, len(word) > 1 and not "一" <= word[0] <= "鿿" and word[-1] != "\ufe0f"))
        yield pd.DataFrame(out, columns=["gram", "word", "n_word", "chain", "latin"])


def garbled_forms(words: DataFrame) -> DataFrame:
    """gram, word, n_word, chain, latin (whether the word is one of Latin letters, not a character or a Chinese pair)."""
    return words.repartition("word").mapInPandas(_forms, "gram string, word string, n_word long, chain int, latin boolean")


def _grams(starts: dict[str, list[int]]):
    """The pieces of each distinct token that may be garbled words: the token itself, its words, and its n-grams that
    begin as a garbled form does (`starts`: the lengths of the forms with a first character)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _sliced(it, 300):
            out = []
            for t, n, plain in zip(pdf["token"], pdf["n"], pdf["plain"], strict=True):
                got = {t, *(w for w in _BREAK(t) if not w.isascii())}
                for i, c in enumerate(t if not plain else ()):
                    for size in starts.get(c, ()):
                        if i + size <= len(t):
                            got.add(t[i : i + size])
                out += [(t, n, plain, g) for g in got]
            yield pd.DataFrame(out, columns=["token", "n_token", "plain", "gram"])

    return run


def _verify(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Undo the chains whose garbled words stand in the token; the original must explain all of it."""
    odd = lambda s: sum(c == "�" or "\x80" <= c <= "\x9f" or "" <= c <= "" for c in s)
    for pdf in it:
        out = []
        for t, chains, proof in zip(pdf["token"], pdf["chains"], pdf["proof"], strict=True):
            best = None
            for k in sorted(chains):
                back = undo(t, CHAINS[k])
                if back and back != t and not odd(back) and len(back) < len(t) + (CHAINS[k][1] in WIDE or CHAINS[k][0] != "utf-8") and (best is None or len(back) < len(best)):
                    best = back
            if best is not None or proof:
                out.append((t, best))
        yield pd.DataFrame(out, columns=["token", "original"])


def garbled_tokens(rows: DataFrame) -> DataFrame:
    """token, original (null where it cannot be regained) of the distinct garbled tokens of `rows`."""
    distinct = rows.groupBy("token").agg(F.count("*").alias("n"))
    # Tokens of Latin letters without a mark of garbling are met as a whole and by their words; the others by n-grams too.
    plain = F.col("token").rlike(f"^[{_LATIN}0-9\\x00-\\x7f’‘“”–—…]+$") & ~F.col("token").rlike(_MARKS)
    distinct = cut(distinct.withColumn("plain", plain))
    words = clean_words(distinct)
    # A form that is itself a usual word or gram of the corpus proves nothing unless its word is far more usual. What
    # comes out of Python is larger than the planner thinks, hence the hints.
    usual = words.select(F.col("word").alias("gram"), F.col("n").alias("n_usual"))
    forms = garbled_forms(words).hint("merge").join(usual, "gram", "left").where(F.coalesce("n_usual", F.lit(0)) * 5 < F.col("n_word")).drop("n_usual")
    forms = cut(forms.where("n_word >= 2 or length(word) > 1"))
    # At most the characters of Unicode with the lengths of two characters under all chains, however large the corpus.
    starts: dict[str, list[int]] = {}
    for r in forms.where("not latin").select(F.substring("gram", 1, 1).alias("c"), F.length("gram").alias("size")).distinct().collect():
        starts.setdefault(r["c"], []).append(r["size"])
    grams = distinct.repartition("token").mapInPandas(_grams(starts), "token string, n_token long, plain boolean, gram string")
    hits = grams.hint("merge").join(forms, "gram").where("not plain or n_token * 5 < n_word")
    hits = hits.groupBy("token", "chain").agg(F.max(F.length("gram")).alias("longest"), F.max(F.length("word")).alias("word"))
    hits = hits.groupBy("token").agg(F.collect_set("chain").alias("chains"), ((F.max("word") > 1) & (F.max("longest") >= 4)).alias("proof"))
    strong = hits.mapInPandas(_verify, "token string, original string")
    sure = distinct.where(F.col("token").rlike(_SURE)).select("token")
    return strong.join(sure, "token", "full").select("token", "original")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields in which at least one stretch was decoded wrongly."""
    rows = field_tokens(spark, sf_dir)
    bad = garbled_tokens(rows).select("token").hint("merge")
    return rows.join(bad, "token", "left_semi").select("tbl", "row_id", "field_name").distinct()


def restore(text: Column, pairs: Column) -> Column:
    """`text` with each token of `pairs` (array of struct<token, original>, longest first) put right."""
    return F.aggregate(pairs, text, lambda acc, p: F.replace(acc, p["token"], p["original"]))


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, field_name, restored: the affected fields with the verified originals in place."""
    rows = field_tokens(spark, sf_dir)
    bad = garbled_tokens(rows).hint("merge")
    pairs = F.array_sort(F.collect_set(F.when(F.col("original").isNotNull(), F.struct(-F.length("token").alias("o"), "token", "original"))))
    per = rows.join(bad, "token").groupBy("tbl", "row_id", "field_name").agg(pairs.alias("pairs"))
    texts = None
    for tbl, key, field in FIELDS:
        x = table(spark, sf_dir, tbl).where(F.col(field).rlike(r"[^\x00-\x7f]")).select(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id"), F.lit(field).alias("field_name"), F.col(field).alias("text"))
        texts = x if texts is None else texts.unionByName(x)
    return per.join(texts, ["tbl", "row_id", "field_name"]).select("tbl", "row_id", "field_name", restore(F.col("text"), F.col("pairs")).alias("restored"))


QUERIES = {"p4_found": p4_found, "p4_restored": p4_restored}
