"""Problem 3: text of scanned pages, repaired into continuous paragraphs.

Words are grouped by a skeleton of strokes that readers of pages confuse (``rn``/``m``, ``cl``/``d``, ``0``/``o``);
in a group a rare form is misread where the frequent form is supported by its neighbours. Chinese characters are
grouped by their surroundings instead: a rare character where one other character is the rule, if the same pair of
characters is met in several surroundings. Running headers and page numbers are found by masking digits: lines
that return over the chunks of a file. Lines are put together again by windows over the lines of each chunk.

No window spans more than a chunk; what concerns a file or the corpus is aggregated with map-side partial sums,
and the line after a chunk's end is fetched by an equi-join on (file, chunk), so a file may hold any share of the
rows.

Defined results: null and empty texts give no rows. Repeated chunks are read each on their own. Rows without
file_name or chunk_index have no neighbours. Texts are processed whole; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, light, table

#: Strokes that a reader of pages takes for each other, in order of application.
STROKES = [("'i'", "t"), ("vv", "w"), ("m", "lll"), ("w", "vv"), ("n", "ll"), ("u", "ll"), ("h", "ll"), ("b", "ll"), ("d", "el")]
STROKE_FROM, STROKE_TO = "i1!|rj059@†c$", "llllllosgates"
HYPHENS = "-­‐¬‑"
_NUM = "[0-9lIO|]{1,4}"
PAGE_NO = rf"^[-–—·*\[(|~]?\s*(?:(?:P[a@][g9]e|Seite|S\.|p\.|P\.|第)\s*)?{_NUM}(?:\s*(?:/|of|von|0f)\s*{_NUM})?\s*頁?\s*[-–—·*\])|~]?$"
EDGE_NO = rf"^{_NUM}\s{{2,}}|\s{{2,}}{_NUM}$"
#: A longer word in small letters: titles have none, lines of running text nearly always.
LOWER_WORD = r"(?:^|\s)\p{Ll}\p{L}{4}"
END_MARKS = r"[.!?。！？,，;；:：…”」）)]$"


def skeleton(word: Column) -> Column:
    """The strokes of a word; words that look alike have the same skeleton."""
    s = F.lower(word)
    for a, b in STROKES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.translate(s, STROKE_FROM, STROKE_TO)


def scan_lines(logs: DataFrame) -> DataFrame:
    """id, file_name, chunk_index, line_no, line, s (line without blanks at its edges)."""
    x = logs.where("raw_content is not null and raw_content <> ''").select("id", "file_name", "chunk_index", F.posexplode(F.split("raw_content", "\n")).alias("line_no", "line"))
    return x.withColumn("s", F.regexp_replace("line", r"^[\s　]+|[\s　]+$", "")).where("s <> ''")


def with_furniture(lines: DataFrame) -> DataFrame:
    """`lines` with ``page_no`` and ``header`` (booleans)."""
    per = Window.partitionBy("id").orderBy("line_no")
    bare = F.col("s").rlike(rf"^{_NUM}$")
    x = lines.withColumn("number", F.col("s").rlike(PAGE_NO) & F.col("s").rlike("[0-9]")).withColumn("bare", bare & F.col("s").rlike("[0-9]"))
    x = x.withColumn("prev_s", F.lag("s").over(per)).withColumn("prev_bare", F.coalesce(F.lag("bare").over(per), F.lit(False))).withColumn("next_bare", F.coalesce(F.lead("bare").over(per), F.lit(False)))
    listed = F.col("bare") & (F.col("prev_bare") | F.col("next_bare") | F.coalesce(F.col("prev_s").rlike("[:：]$"), F.lit(False)))
    x = x.withColumn("page", F.col("number") & ~listed)
    value = F.translate(F.regexp_extract("s", rf"({_NUM})", 1), "lI|O", "1110").try_cast("int")
    style = F.regexp_replace("s", "[0-9lIO|]+", "#")
    styles = x.where("page").groupBy("file_name", style.alias("style")).agg(F.count("*").alias("n"), F.try_divide(F.covar_pop(value.cast("double"), F.col("chunk_index").cast("double")), F.stddev_pop(value) * F.stddev_pop("chunk_index")).alias("rising"))
    numbered = styles.where("n < 4 or rising is null or rising > 0.3").select("file_name", "style", F.lit(True).alias("is_style"))
    x = x.withColumn("style", F.when(F.col("page"), style)).join(numbered, ["file_name", "style"], "left").withColumn("page_no", F.col("page") & F.coalesce("is_style", F.lit(False)))
    # Headers: short lines without an end mark that return in the file, digits and misread glyphs aside.
    width = x.where("not page").groupBy("file_name").agg(F.percentile_approx(F.length("s"), 0.9, 1000).alias("width"))
    edge = F.col("s").rlike(EDGE_NO)
    x = x.withColumn("near_page", F.coalesce(F.lag("page_no").over(per), F.lit(False)) | F.coalesce(F.lead("page_no").over(per), F.lit(False))).withColumn("edge", edge & ~F.col("page"))
    x = x.withColumn("title", F.regexp_replace("s", EDGE_NO, "")).join(width, "file_name", "left")
    marked = F.col("title").rlike(END_MARKS) | F.col("title").rlike(r"[，。]") | F.col("title").rlike(f"[{HYPHENS}]$") | ~F.col("title").rlike(r"^[\p{Lu}\p{Lo}'0-9|!†@]")
    x = x.withColumn("titled", ~F.col("page") & ~marked & (F.length("title") >= 3) & (F.col("edge") | (F.length("title") < 0.8 * F.col("width"))))
    x = x.withColumn("key", F.when(F.col("titled"), skeleton(F.regexp_replace("title", r"\s+", " "))))
    # A file may alternate several headers, so each key is decided by itself: by a number beside it, or as a title that returns in a paged file.
    proven = F.col("edge") | F.col("near_page")
    keys = x.where("titled").groupBy("file_name", "key").agg(F.count_distinct("chunk_index").alias("chunks"), F.sum(F.col("edge").cast("int") + F.col("near_page").cast("int")).alias("proof"), F.count("*").alias("n"), F.count_if(proven).alias("n_proven"), F.bool_or(~F.col("title").rlike(LOWER_WORD)).alias("capital"))
    order = F.struct(F.least("proof", F.lit(1)).alias("proven"), "chunks", "proof", "key")
    best = keys.groupBy("file_name").agg(F.max(order).alias("m"))
    paged = x.where("page_no").select("file_name", F.lit(True).alias("paged")).distinct()
    first = (F.col("key") == F.col("m.key")) & (((F.col("chunks") >= 2) & F.col("paged")) | (F.col("proof") >= 1))
    further = (F.col("capital") & ((F.col("n_proven") >= 1) | ((F.col("chunks") >= 2) & F.col("paged")))) | ((F.col("chunks") >= 2) & (F.col("n_proven") >= 2) & (F.col("n_proven") * 2 >= F.col("n")))
    heads = keys.join(best, "file_name").join(paged, "file_name", "left").where(first | further).select("file_name", "key", F.lit(True).alias("is_head"))
    x = x.join(heads, ["file_name", "key"], "left").withColumn("header", F.col("titled") & F.coalesce("is_head", F.lit(False)))
    return x.select("id", "file_name", "chunk_index", "line_no", "line", "s", "page_no", "header")


#: A word with what a reader may have put into it; marks at its edges are cut.
_WORD = r"[\p{L}0-9@!†](?:[\p{L}0-9@!†|$'’]*[\p{L}0-9@†])?"
#: What may not stand before and after a word that is put right.
_BEFORE, _AFTER = r"(?<![\p{L}0-9@!†])(?<![\p{L}0-9]['’|$])", r"(?!['’|$!]*[\p{L}0-9@†])"


def words_of(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(f"({_WORD})"), F.lit(0))


def with_hyphens(body: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """id, line_no of the body lines that end in the first part of a broken word, with the whole word, its rest, and
    whether that stands in the file's next chunk."""
    per = Window.partitionBy("id").orderBy("line_no")
    x = body.withColumn("next_s", F.lead("s").over(per))
    firsts = body.groupBy("file_name", "chunk_index").agg(F.min_by("s", F.struct("id", "line_no")).alias("first_s"))
    firsts = firsts.select("file_name", (F.col("chunk_index") - 1).alias("chunk_index"), "first_s")
    x = x.where(F.col("s").rlike(rf"\p{{L}}[{HYPHENS}]$")).join(firsts, ["file_name", "chunk_index"], "left").withColumn("after", F.coalesce("next_s", "first_s"))
    x = x.select("id", "line_no", "file_name", "chunk_index", F.col("next_s").isNull().alias("crosses"), F.regexp_extract("s", rf"([\p{{L}}0-9@!†|’']+)[{HYPHENS}]$", 1).alias("a"), F.regexp_extract("after", r"^([\p{L}0-9@!†|’']+)", 1).alias("b"), F.regexp_extract("s", rf"([\p{{L}}]+-)[\p{{L}}0-9@!†|]+[{HYPHENS}]$", 1).alias("c"), F.regexp_extract("s", rf"([{HYPHENS}])$", 1).alias("mark"))
    x = x.where("a <> '' and b <> ''").withColumn("whole", F.lower(F.concat("a", "b"))).withColumn("own", F.lower(F.concat("a", F.lit("-"), "b")))
    v = vocabulary.select(F.col("word"), "n")
    x = x.withColumn("whole_key", skeleton(F.col("whole"))).withColumn("own_key", skeleton(F.col("own")))
    k = v.groupBy(skeleton(F.col("word")).alias("k")).agg(F.sum("n").alias("n"))
    x = x.join(k.select(F.col("k").alias("whole_key"), F.col("n").alias("n_whole")), "whole_key", "left").join(k.select(F.col("k").alias("own_key"), F.col("n").alias("n_own")), "own_key", "left")
    n_whole, n_own = F.coalesce("n_whole", F.lit(0)), F.coalesce("n_own", F.lit(0))
    lower = F.col("b").rlike(r"^\p{Ll}|^[0-9@!†|]\p{Ll}")
    return x.where((n_whole > n_own) | ((n_whole == 0) & (n_own == 0) & lower & (F.col("mark") != "-"))).select("id", "line_no", "whole", F.col("b").alias("rest"), "crosses", "file_name", "chunk_index")


def misread_words(body: DataFrame, broken: DataFrame) -> DataFrame:
    """id, line_no, word, right: words in a rare form where the frequent form of their skeleton fits."""
    x = body.join(broken.select("id", "line_no", F.lit(True).alias("breaks")), ["id", "line_no"], "left")
    per = Window.partitionBy("id").orderBy("line_no")
    x = x.withColumn("goes_on", F.coalesce(F.lag("breaks").over(per), F.lit(False))).withColumn("breaks", F.coalesce("breaks", F.lit(False)))
    addresses, cue = r"\S+@\S+\.\S+|\S+ ?[\[(](?:at|AT)[\])] ?\S+", r"@|[\[(](?:at|AT)[\])]"
    x = x.withColumn("w", words_of(F.when(F.col("s").rlike(cue), F.regexp_replace("s", addresses, " , ")).otherwise(F.col("s"))))
    # Parts of broken words are no words.
    a = F.when(F.col("goes_on"), 2).otherwise(1)
    x = x.withColumn("w", F.slice("w", a, F.greatest(F.lit(0), F.size("w") - F.col("breaks").cast("int") - a + 1)))
    x = cut(x.where("size(w) > 0").select("id", "line_no", "w"))
    w = x.select("id", "line_no", F.posexplode("w").alias("i", "word"), F.col("w")).where(F.col("word").rlike(r"\p{L}"))
    w = w.select("id", "line_no", F.col("word").alias("raw"), F.lower("word").alias("word"), F.lower(F.get("w", F.col("i") - 1)).alias("p"), F.lower(F.get("w", F.col("i") + 1)).alias("q"))
    w = w.where(~F.col("word").rlike("[一-鿿]"))
    # Pairs of neighbours, counted once: they give the words' counts and what stands before and after each word.
    pairs = cut(w.groupBy("p", "word").agg(F.count("*").alias("n")))
    counts = pairs.groupBy("word").agg(F.sum("n").alias("n"))
    plain = F.col("word").rlike(r"^[\p{L}'’]+$")
    forms = counts.withColumn("key", skeleton(F.col("word")))
    top = forms.where(plain).groupBy("key").agg(F.max(F.struct("n", "word")).alias("top")).select("key", F.col("top.word").alias("right"), F.col("top.n").alias("n_right"))
    rare = forms.where(F.length("word") >= 2).join(top, "key").where((F.col("word") != F.col("right")) & (F.col("n_right") >= 5) & (F.col("n") * 8 <= F.col("n_right"))).select("word", "n", "right", "n_right")
    rare = light(cut(rare))
    usual = pairs.where("p is not null").withColumnRenamed("n", "n_pw")
    after = pairs.where("p is not null").select(F.col("p").alias("word"), F.col("word").alias("q"), F.col("n").alias("n_wq"))
    x = w.join(rare, "word").join(usual.select("p", F.col("word").alias("right"), "n_pw"), ["p", "right"], "left").join(after.select(F.col("word").alias("right"), "q", "n_wq"), ["right", "q"], "left")
    odd = ~F.col("word").rlike(r"^[\p{L}'’]+$")
    fits = F.coalesce("n_pw", F.lit(0)) + F.coalesce("n_wq", F.lit(0))
    return x.where((fits >= 3) | odd).select("id", "line_no", F.col("raw").alias("word"), "right")


def misread_characters(body: DataFrame) -> DataFrame:
    """id, line_no, at, right: Chinese characters that are rare where another one is the rule."""
    zh = body.where(F.col("s").rlike("[一-鿿]{3}")).withColumn("t", F.concat(F.lit("^^"), "s", F.lit("$$")))
    x = zh.select("id", "line_no", F.posexplode(F.expr("transform(sequence(1, length(t) - 4), i -> substring(t, i, 5))")).alias("at", "g"))
    x = x.where(F.substring("g", 3, 1).rlike("[一-鿿]")).select("id", "line_no", "at", F.concat(F.substring("g", 1, 2), F.substring("g", 4, 2)).alias("around"), F.substring("g", 3, 1).alias("c"))
    n = cut(x.groupBy("around", "c").agg(F.count("*").alias("n")))
    rule = n.groupBy("around").agg(F.max(F.struct("n", "c")).alias("top")).select("around", F.col("top.c").alias("right"), F.col("top.n").alias("n_right")).where("n_right >= 5")
    rare = n.join(rule, "around").where((F.col("c") != F.col("right")) & (F.col("n") * 8 <= F.col("n_right")))
    pairs = rare.groupBy("c", "right").agg(F.count("*").alias("places"), F.sum("n").alias("times")).where("places >= 4")
    # A pair is one of glyphs if the rare character seldom has places of its own beside those.
    single = pairs.groupBy("c").agg(F.max(F.struct("places", "right")).alias("m"), F.sum("places").alias("all")).where(F.col("m.places") >= 0.6 * F.col("all")).select("c", F.col("m.right").alias("right"))
    # What is seen of a usual character beside its right place must be no mere chance of its many places.
    total = n.groupBy("c").agg(F.sum("n").alias("total"))
    single = single.join(pairs, ["c", "right"]).join(total, "c").where("times >= 0.025 * total").select("c", "right")
    bad = light(cut(rare.join(single, ["c", "right"]).select("around", "c", "right")))
    return x.join(bad, ["around", "c"]).select("id", "line_no", "at", "right")


def scan_noise(logs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(lines with furniture, broken words, misread words, misread characters) of the scanned files.

    A file is scanned if page furniture or broken words stand in it; glyphs are looked for in these files."""
    lines = cut(with_furniture(scan_lines(logs)))
    body = lines.where("not page_no and not header")
    inner = body.select(F.explode(F.filter(F.split(F.lower("s"), r"[^\p{L}0-9'’@!†|-]+"), lambda w: ~w.rlike("-$") & (w != ""))).alias("word"))
    vocabulary = inner.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")
    broken = cut(with_hyphens(body, vocabulary))
    files = lines.where("page_no or header").select("file_name").unionByName(lines.join(broken, ["id", "line_no"], "left_semi").select("file_name")).distinct()
    words = misread_words(body, broken)
    chars = misread_characters(body)
    ids = cut(lines.join(files, "file_name", "left_semi").select("id").distinct())
    return lines, broken, words.join(ids, "id", "left_semi"), chars.join(ids, "id", "left_semi")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with scan noise, by kind."""
    lines, broken, words, chars = scan_noise(table(spark, sf_dir, "writing_style_logs").select("id", "file_name", "chunk_index", "raw_content"))
    kind = lambda df, k: df.select("id", F.col("line_no").cast("long").alias("line_no"), F.lit(k).alias("kind"))
    found = kind(lines.where("header"), "header").unionByName(kind(lines.where("page_no and not header"), "page_no")).unionByName(kind(broken, "hyphen"))
    return found.unionByName(kind(words, "glyph")).unionByName(kind(chars, "glyph")).distinct()


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, repaired: the chunk as paragraphs, without furniture, with whole and right words."""
    lines, broken, words, chars = scan_noise(table(spark, sf_dir, "writing_style_logs").select("id", "file_name", "chunk_index", "raw_content"))
    fix = words.groupBy("id", "line_no").agg(F.collect_set(F.struct("word", "right")).alias("fix"))
    put = chars.groupBy("id", "line_no").agg(F.collect_set(F.struct("at", "right")).alias("put"))
    x = lines.where("not page_no and not header").join(fix, ["id", "line_no"], "left").join(put, ["id", "line_no"], "left").join(broken.drop("file_name", "chunk_index"), ["id", "line_no"], "left")
    # The rest of a word that is broken over a chunk's end goes to its first part, in every copy of both chunks.
    taken = broken.where("crosses").groupBy("file_name", (F.col("chunk_index") + 1).alias("chunk_index")).agg(F.max("rest").alias("taken"))
    per = Window.partitionBy("id").orderBy("line_no")
    x = x.withColumn("first", F.row_number().over(per) == 1).join(taken, ["file_name", "chunk_index"], "left")
    same_case = lambda p: F.when(p["word"].rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(p["right"], 1, 1)), F.substring(p["right"], F.lit(2), F.length(p["right"])))).otherwise(p["right"])
    whole_word = lambda p: F.concat(F.lit(_BEFORE + r"\Q"), p["word"], F.lit(r"\E" + _AFTER))
    t = F.aggregate(F.coalesce("put", F.array().cast("array<struct<at:int,right:string>>")), F.col("s"), lambda acc, p: F.overlay(acc, p["right"], p["at"] + 1, F.lit(1)))
    t = F.when(F.col("first") & F.startswith(t, F.col("taken")), F.ltrim(F.substring(t, F.length("taken") + 1, F.length(t)))).otherwise(t)
    t = F.aggregate(F.coalesce("fix", F.array().cast("array<struct<word:string,right:string>>")), t, lambda acc, p: F.regexp_replace(acc, whole_word(p), same_case(p)))
    t = F.when(F.col("whole").isNotNull(), F.concat(F.regexp_replace(t, f"[{HYPHENS}]$", ""), F.when(F.col("crosses"), F.col("rest")).otherwise(""))).otherwise(t)
    x = x.withColumn("t", t).withColumn("glued", F.lag(F.col("whole").isNotNull()).over(per)).withColumn("prev_s", F.lag("s").over(per)).withColumn("len", F.max(F.length("s")).over(Window.partitionBy("id")))
    # A line that ends a sentence well before the edge ends its paragraph.
    gap = F.when(F.col("prev_s").isNull(), "").when(F.col("glued"), "").when(F.col("prev_s").rlike(r"[.!?。！？:：]$") & (F.length("prev_s") < 0.7 * F.col("len")), "\n\n").when(F.col("prev_s").rlike("[一-鿿，。、）]$"), "").otherwise(" ")
    return x.withColumn("t", F.concat(gap, "t")).groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "t"))), lambda p: p["t"]), "").alias("repaired")).withColumn("repaired", F.trim("repaired"))


QUERIES = {"p3_found": p3_found, "p3_repaired": p3_repaired}
