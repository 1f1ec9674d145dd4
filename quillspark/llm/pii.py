"""Problem 5: personal data in free text, found by anchor expansion and replaced by typed placeholders.

An Aho-Corasick automaton finds the anchors of each line: at-signs in any spelling, names of the corpus's own
name vocabulary, identifier cues, street words, town suffixes and runs of digits. Deterministic parsers grow each
anchor to the datum around it and validate its shape. The name vocabulary is learned from the corpus: names that
stand in places where only names stand (before an address in brackets, before "wrote", in a contact block, after
"belongs to"), counted in Spark with map-side aggregation.

The vocabulary, with the names' garbled forms, saturates (it holds distinct given names and surnames), but it has no
proven bound, so its size is checked: up to ``BROADCAST_NAMES`` forms it is broadcast; beyond, whatever in a text may be
a name (what begins and ends where letters do) is hash-joined with it, and a batch of texts is parsed with the names that
stand in it. Both ways give the same result.

Defined results: null and empty texts have no data and stay as they are. Each datum lies on one line. Repeated
rows count each on their own. Texts of any length are processed whole; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table

FIELDS = [("message_data", "msg_no", "page_content"), ("writing_style_logs", "id", "raw_content")]
BROADCAST_NAMES = 200_000
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_no": "[ID_NO]", "address": "[ADDRESS]", "person": "[PERSON]"}

#: The most usual Chinese surnames.
SURNAMES_ZH = "陳林黃張李王吳劉蔡楊許鄭謝洪郭邱曾廖賴徐周葉蘇莊呂江何蕭羅高潘簡朱鍾游詹胡施沈余盧梁趙顏柯孫魏翁戴范方宋鄧杜傅侯曹薛丁卓馬董溫唐藍蔣石古紀姚連歐程湯馮康姜汪田鄒尤巫龔"
#: Words at the end of English street names.
STREET_WORDS = ["Street", "Road", "Lane", "Avenue", "Row", "Path", "Quay", "Drive", "Close", "Way", "Hill", "Court", "Place", "Square", "Terrace", "Gardens", "Crescent", "Walk", "Mews", "Boulevard", "Parade"]
#: Ends of German street names.
STREET_ENDS = ["straße", "strasse", "str.", "weg", "allee", "gasse", "platz", "stieg", "ufer", "damm", "ring", "pfad", "steig", "chaussee"]
#: Titles before surnames; the title is no part of the name.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Frau", "Herr", "Herrn"]

_U, _L = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_NAME = f"[{_U}][{_L}]+"
_PAIR = f"({_NAME}) ({_NAME}(?:-{_NAME})?)"
#: Marks before and after a pair of capitalised words that make it a full name.
_PAIR_RE = re.compile(rf"(?<![\w@.\-])({_NAME}) ({_NAME}(?:-{_NAME})?)(?![\w@])")
_NAME_BEFORE = re.compile(r"(?:belongs to|gehört zu|According to|can reach|idea why|und nach|, sagt|(?:^|[>|¦»]\s?)--|schrieb)\s$|^On .{8,40}, $")
_NAME_AFTER = re.compile(r" <[^<>\s@]+@|:?$(?<=:)| (?:wrote|writes|schrieb|answers at|ist unter|wohnt jetzt)\b| (?:/|·) |['’]s flat")
NAME_PLACES_ZH = r"([" + SURNAMES_ZH + r"])([一-鿿]{2})(?: <[^<>\s@]+@|於\d{4}|寫道| / | · |的身分證|的證號|的統編|住在|（[^）\s]{1,40}[@＠])"


_ZH_RE = re.compile(NAME_PLACES_ZH)


def _count_names(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of (given name, surname), and of the characters of Chinese given names (surname null)."""
    for pdf in it:
        n: Counter = Counter()
        for text in pdf["text"]:
            for line in text.split("\n"):
                for m in _PAIR_RE.finditer(line):
                    if _NAME_AFTER.match(line, m.end()) or _NAME_BEFORE.search(line, max(0, m.start() - 60), m.start()):
                        n[m[1], m[2]] += 1
                if not line.isascii():
                    for m in _ZH_RE.finditer(line):
                        n[m[2][0], None] += 1
                        n[m[2][1], None] += 1
        yield pd.DataFrame([(g, s, k) for (g, s), k in n.items()], columns=["g", "s", "n"])


def name_vocabulary(texts: DataFrame) -> DataFrame:
    """kind (given, surname, zh), name, n: the names learned from `texts` (column text)."""
    counted = texts.select("text").mapInPandas(_count_names, "g string, s string, n long")
    counted = cut(counted.groupBy("g", "s").agg(F.sum("n").alias("n")))
    pairs = counted.where("s is not null")
    # A given name goes with several surnames and a surname with several given names, or the pair is frequent.
    given = pairs.groupBy("g").agg(F.sum("n").alias("n"), F.count("*").alias("m")).where((F.col("m") >= 3) & (F.col("n") >= 4) & ~F.col("g").isin(TITLES)).select(F.lit("given").alias("kind"), F.col("g").alias("name"), "n")
    surname = pairs.join(given.select(F.col("name").alias("g")), "g", "left_semi").groupBy("s").agg(F.sum("n").alias("n")).where("n >= 2").select(F.lit("surname").alias("kind"), F.col("s").alias("name"), "n")
    zh = counted.where("s is null").select(F.col("g").alias("name"), "n")
    total = zh.agg(F.sum("n").alias("total"))
    zh = zh.join(F.broadcast(total)).where("n >= 0.004 * total and n >= 3").select(F.lit("zh").alias("kind"), "name", "n")
    return given.unionByName(surname).unionByName(zh)


#: One character to one character, so that places in the text stay.
_FOLD = {ord("＠"): "@", ord("．"): ".", ord("－"): "-", ord("（"): "(", ord("）"): ")", ord("＋"): "+", ord("　"): " ", ord(" "): " ", ord("–"): "-"} | {0xFF10 + i: str(i) for i in range(10)} | {0xFF21 + i: chr(65 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}

_LOCAL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9_+])?"
_AT = r"(?: ?@ ?| ?[\[({<] ?(?:at|AT|ät|@) ?[\])}>] ?| (?:at|AT) )"
_DOT = r"(?:\.| ?[\[({<] ?(?:dot|DOT|punkt|\.) ?[\])}>] ?| (?:dot|DOT|punkt) )"
_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+\-@]){_LOCAL}(?:{_DOT}{_LOCAL})?{_AT}[A-Za-z0-9\-]+(?:{_DOT}[A-Za-z0-9\-]+)*{_DOT}[A-Za-z]{{2,12}}(?![A-Za-z0-9])")
_PLAIN_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+\-@]){_LOCAL}@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{{2,12}}(?![A-Za-z0-9])")
_PHONE = re.compile(
    r"(?<![\dA-Za-z.+#/:\-])(?:(?:\+|00)\d{1,3}[ \-./]?(?:\(0\)[ ]?|\(\d{1,4}\)[ ]?)?\d{1,4}(?:[ \-./]?\d{2,8}){1,4}|\(0?\d{2,4}\)[ \-./]?\d{3,5}[ \-./]?\d{2,5}(?:[ \-./]\d{2,4})?"
    r"|0\d{1,4}[ \-./]\d{3,8}(?:[ \-./]\d{2,6}){0,2}|0\d{8,10}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\dA-Za-z]|[.\-:/]\d)"
)
_ID = re.compile(
    r"(?<![A-Za-z0-9\-])(?:QQ ?\d{2} ?\d{2} ?\d{2} ?[A-D]|[A-Z]\d{8}|\d{3}([ \-])\d{2}\1\d{4}|\d{9}(?=\D|$)|[A-Za-z][12]\d{8}|[CFGHJKLMNPRTVWXYZ][0-9CFGHJKLMNPRTVWXYZ]{8}\d|\d{2} \d{3} \d{3} \d{3}|\d{11})(?![A-Za-z0-9]|-\d)",
)
_NO_ID_BEFORE = re.compile(r"(?:order|ticket|invoice|version|build|bestellung|rechnung|vorgang|訂單|發票|單號|版本|case|no idea)[ .:#]*(?:nr\.?|no\.?)? ?$", re.I)
_ZH_TAX = re.compile(r"(?:統編|統一編號)(?:是|：|:| )*(\d{8})(?!\d)")
_ADDR_EN = re.compile(rf"(?<![\w\-])(?:(?:Flat|Apt\.?|Apartment|Unit|Suite) \d+[A-Za-z]?, )?\d{{1,5}}[A-Za-z]? (?:[{_U}][\w’']+ ){{1,3}}(?:{'|'.join(STREET_WORDS)})(?:, [{_U}][\w’'\-]+(?: [{_U}][\w’'\-]+){{0,2}})?(?:,? \d{{5}}(?!\d)|,? [A-Z]{{1,2}}\d[\dA-Z]? \d[A-Z]{{2}})?")
_ADDR_DE = re.compile(rf"(?<![\w\-])[{_U}][\w\-]*?(?:{'|'.join(re.escape(x) for x in STREET_ENDS)}) \d{{1,4}}(?: ?[a-z](?![a-z]))?, (?:D-)?\d{{5}} [{_U}][\w\-]+(?: (?:am|an der|im|in der|bei|ob der) [{_U}][\w\-]+)?")
_ADDR_ZH = re.compile(r"[一-鿿]{2}[市縣](?:[一-鿿]{1,3}[區鄉鎮市])?[一-鿿]{1,4}?(?:路|街|大道|巷)(?:[\d一二三四五六七八九十]+段)?(?:\d+巷)?(?:\d+弄)?\d+(?:之\d+)?號(?:\d+樓)?(?:之\d+)?")


_DIGIT = re.compile(r"\d")
#: Words that announce a number of a person, where the number alone doesn't tell.
ID_CUES = ["social security", "ssn", "tax id", "tax number", "tin", "steuer-id", "steuernummer", "identifikationsnummer", "passport", "reisepass", "ausweis", "insurance number", "身分證", "證號", "護照"]
#: How far from its cue such a number may begin.
CUE_REACH = 40


def tax_digits(n: str) -> bool:
    """Whether the last of eleven digits checks the others (modulo 11, 10), as German tax numbers have it."""
    product = 10
    for c in n[:-1]:
        total = (int(c) + product) % 10 or 10
        product = total * 2 % 11
    return n[0] != "0" and len(set(n[:-1])) < 10 and (11 - product) % 10 == int(n[-1])


def name_forms(name: str) -> set[str]:
    """The name, and what it is when a letter outside ASCII was read in a wrong encoding."""
    from .mojibake import CHAINS, garble

    return {name} | {g for c in CHAINS if not name.isascii() and (g := garble(name, c)) and "�" not in g and g.isprintable() and len(g) > 2}


def _expand(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = [(k, f) for k, n in zip(pdf["kind"], pdf["name"], strict=True) for f in (name_forms(n) if k != "zh" else (n,))]
        yield pd.DataFrame(out, columns=["kind", "name"])


_RUN = re.compile(r"[^\x00-\x26\x28-\x2c\x2e-\x40\x5b-\x60\x7b-\x7f\s]+")


def possible_names(text: str, longest: int) -> set[str]:
    """In lower case, whatever in the text begins and ends where letters do, without blanks, and has at most `longest`
    characters: all that the anchors of names can meet."""
    out: set[str] = set()
    for run in {m[0] for m in _RUN.finditer(text)}:
        low = run.lower()
        if len(low) != len(run):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in run)
        alpha = [c.isalpha() for c in low]
        starts = [i for i in range(len(low)) if not (i and alpha[i - 1])]
        ends = [i + 1 for i in range(len(low)) if not (i + 1 < len(low) and alpha[i + 1])]
        out.update(low[a:b] for a in starts for b in ends if a < b <= a + longest)
    return out


class Parser:
    """The parsers of one worker, for a vocabulary of names."""

    def __init__(self, given: set[str], surname: set[str], zh: set[str]) -> None:
        self.given, self.surname = given, surname
        self.lower = {x.lower() for x in self.given}, {x.lower() for x in self.surname}
        self.zh = "".join(sorted(zh))
        self.zh_name = re.compile(f"[{SURNAMES_ZH}]?[{self.zh}]{{2}}") if zh else None
        self.anchors = ahocorasick.Automaton()
        at = ["@", "＠", "[at]", "(at)", "{at}", "<at>", "[ät]", "(ät)", " at ", "[@]"]
        for kind, found in (("at", at), ("en", [f" {x.lower()}" for x in STREET_WORDS]), ("de", [f"{x} " for x in STREET_ENDS]), ("zh", ["號"]), ("tax", ["統編", "統一編號"]), ("cue", ID_CUES), ("name", self.lower[0] | self.lower[1])):
            for w in found:
                old = self.anchors.get(w, (frozenset(), 0))
                self.anchors.add_word(w, (old[0] | {kind}, len(w)))
        self.anchors.make_automaton()

    def find(self, text: str) -> set[tuple[str, str]]:
        out: set[tuple[str, str]] = set()
        for line in text.split("\n"):
            if line:
                out.update((kind, line[a:b]) for a, b, kind in self.spans(line))
        return out

    def spans(self, line: str) -> list[tuple[int, int, str]]:
        """Places of the data on one line, without overlaps, the surest kind first."""
        plain = line.isascii()
        folded = line if plain else line.translate(_FOLD)
        low = line.lower()
        if len(low) != len(line):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
        kinds, names, cues = set(), [], []
        for end, (k, size) in self.anchors.iter(low):
            kinds |= k
            if "cue" in k:
                cues.append(end + 1)
            if "name" in k:
                a = end + 1 - size
                if not (a and low[a - 1].isalpha()) and not low[end + 1 : end + 2].isalpha():
                    names.append((a, end + 1))
        digits = len(_DIGIT.findall(folded))
        got: list[tuple[int, int, str]] = []
        free = lambda a, b: all(b <= x or a >= y for x, y, _ in got)

        def take(a: int, b: int, kind: str) -> None:
            if free(a, b):
                got.append((a, b, kind))

        if "at" in kinds:
            for m in _PLAIN_EMAIL.finditer(folded):
                take(m.start(), m.end(), "email")
            for m in _EMAIL.finditer(folded):
                if " at " not in m[0].lower() or re.search(r"[ \[({<](?:dot|punkt)[ \])}>]|\.", m[0].lower().partition(" at ")[2]):
                    take(m.start(), m.end(), "email")
        if digits:
            if "zh" in kinds:
                for m in _ADDR_ZH.finditer(folded):
                    a = m.start()
                    for cue in ("住在", "寄到", "寄給", "地址", "送到", "在", "到"):  # the words before the town
                        if folded[a : m.end()].startswith(cue):
                            a += len(cue)
                    take(a, m.end(), "address")
            if "en" in kinds:
                for m in _ADDR_EN.finditer(folded):
                    take(m.start(), m.end(), "address")
            if "de" in kinds:
                for m in _ADDR_DE.finditer(folded):
                    take(m.start(), m.end(), "address")
            if "tax" in kinds:
                for m in _ZH_TAX.finditer(folded):
                    take(m.start(1), m.end(1), "id_no")
            for m in _ID.finditer(folded) if digits >= 6 else ():
                # Nine digits, or eleven whose last one doesn't check the others, need a word that announces them.
                if m[0].isdigit() and not (len(m[0]) == 11 and tax_digits(m[0])) and not any(0 <= m.start() - c <= CUE_REACH for c in cues):
                    continue
                if not _NO_ID_BEFORE.search(folded[: m.start()]):
                    take(m.start(), m.end(), "id_no")
            for m in _PHONE.finditer(folded) if digits >= 8 else ():
                n = sum(c.isdigit() for c in m[0])
                if 8 <= n <= 15 and not _NO_ID_BEFORE.search(folded[: m.start()]) and not re.match(r"(?:19|20)\d{2}[.\-]", m[0]) and not re.match(r"\d{2}[./\-]\d{2}[./\-]\d{4}$", m[0]):
                    take(m.start(), m.end(), "phone")
        self._people(line, names, plain, take)
        return got

    def _people(self, line: str, names: list[tuple[int, int]], plain: bool, take: Callable) -> None:
        longest: dict[int, int] = {}
        for a, b in names:
            longest[a] = max(b, longest.get(a, 0))
        words = [(a, b, line[a:b]) for a, b in sorted(longest.items())]
        i = 0
        while i < len(words):
            a, b, w = words[i]
            nxt = words[i + 1] if i + 1 < len(words) and line[b : words[i + 1][0]] == " " else None
            before = line[max(0, a - 12) : a]
            joined = (before[-1:] in ("@", "_", "+", "＠", "/")) or re.match(r"[@＠_+]|\.[A-Za-z0-9]", line[b:]) or re.search(r"[\w][.\-]$", before) and not re.search(r"(?:^|[^\w])[A-Z]\.$", before)
            if joined:
                i += 1
                continue
            if w in self.given:
                if nxt and nxt[2] in self.surname:
                    take(a, nxt[1], "person")
                    i += 2
                    continue
                if w in self.surname and re.search(r"(?:^|[^\w])[A-Z]\. $", before):
                    a -= 3
                take(a, b, "person")
            elif w in self.surname:
                take(a - 3 if re.search(r"(?:^|[^\w])[A-Z]\. $", before) else a, b, "person")
            elif nxt and (w.lower() in self.lower[0] and nxt[2].lower() in self.lower[1]):
                take(a, nxt[1], "person")
                i += 2
                continue
            elif w.lower() in self.lower[0] and (w.isupper() and len(w) > 2 or re.search(r"(?:Name|name|姓名|From|To|Von|An)[:：] ?$", before)):
                take(a, b, "person")
            elif w.lower() in self.lower[1] and re.search(r"(?:^|[^\w])[A-Za-z]\. $", before):
                take(a - 3, b, "person")
            elif w.lower() in self.lower[1] and w.isupper() and len(w) > 3:
                take(a, b, "person")
            i += 1
        if self.zh_name and not plain:
            for m in self.zh_name.finditer(line):
                take(m.start(), m.end(), "person")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for tbl, key, field in FIELDS:
        x = table(spark, sf_dir, tbl).select(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id"), F.col(field).alias("text")).where("text is not null and text <> ''")
        out = x if out is None else out.unionByName(x)
    return out


def _with_parser(texts: DataFrame, names: DataFrame, work: Callable, schema: str) -> DataFrame:
    """mapInPandas of `work(parser, pdf)` with the vocabulary broadcast, or joined to each text if it is large."""
    names = cut(names.select("kind", "name").mapInPandas(_expand, "kind string, name string").distinct())
    if names.count() <= BROADCAST_NAMES:
        sets: dict[str, set] = {"given": set(), "surname": set(), "zh": set()}
        for r in names.collect():
            sets[r["kind"]].add(r["name"])
        shared = texts.sparkSession.sparkContext.broadcast(sets)

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p = Parser(**shared.value)
            for pdf in it:
                yield work(p, pdf)

        return texts.mapInPandas(run, schema)
    # Characters of Chinese given names are at most one in 0.004 of all: a few hundred.
    zh = {r["name"] for r in names.where("kind = 'zh'").collect()}
    words = names.where("kind <> 'zh'").select(F.lower("name").alias("low"), "kind", "name")
    longest = words.agg(F.max(F.length("name"))).first()[0] or 0

    def met(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for i in range(0, len(pdf), 200):
                part = pdf.iloc[i : i + 200]
                out = [(t, r, w) for t, r, text in zip(part["tbl"], part["row_id"], part["text"], strict=True) for w in possible_names(text, longest)]
                yield pd.DataFrame(out, columns=["tbl", "row_id", "low"])

    per = texts.mapInPandas(met, "tbl string, row_id long, low string").hint("merge").join(words, "low").groupBy("tbl", "row_id").agg(F.collect_set(F.struct("kind", "name")).alias("names"))

    def each(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sets: dict[str, set] = {"given": set(), "surname": set(), "zh": zh}
            for own in pdf["names"]:
                for x in own if own is not None else []:
                    sets[x["kind"]].add(x["name"])
            yield work(Parser(**sets), pdf)

    return texts.join(per.hint("merge"), ["tbl", "row_id"], "left").mapInPandas(each, schema)


def _found(p: Parser, pdf: pd.DataFrame) -> pd.DataFrame:
    out = [(t, r, kind, datum) for t, r, text in zip(pdf["tbl"], pdf["row_id"], pdf["text"], strict=True) for kind, datum in sorted(p.find(text))]
    return pd.DataFrame(out, columns=["tbl", "row_id", "kind", "pii_text"])


def _masked(p: Parser, pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for t, r, text in zip(pdf["tbl"], pdf["row_id"], pdf["text"], strict=True):
        lines = []
        for line in text.split("\n"):
            for a, b, kind in sorted(p.spans(line), reverse=True):
                line = line[:a] + PLACEHOLDERS[kind] + line[b:]
            lines.append(line)
        out.append((t, r, "\n".join(lines)))
    return pd.DataFrame(out, columns=["tbl", "row_id", "masked"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct personal datum of each text."""
    texts = _texts(spark, sf_dir)
    return _with_parser(texts, name_vocabulary(texts), _found, "tbl string, row_id long, kind string, pii_text string").distinct()


def p5_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, masked: the texts with typed placeholders, otherwise unchanged."""
    texts = _texts(spark, sf_dir)
    return _with_parser(texts, name_vocabulary(texts), _masked, "tbl string, row_id long, masked string")


QUERIES = {"p5_found": p5_found, "p5_masked": p5_masked}
