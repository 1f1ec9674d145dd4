"""JSON exports of social media, and the rag-ready JSON of this chain, as variants: no shape is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.ingest import merged, standardized_map
from ..operators.threads import match_comments, orphan_posts

_URI = "array<struct<uri:string>>"
_NESTED = "array<struct<data:array<struct<media:struct<uri:string>,external_context:struct<url:string>,audio_file:struct<uri:string>>>>>"
_POST = f"struct<timestamp:string,creation_timestamp:string,title:string,data:array<struct<post:string>>,photos:{_URI},videos:{_URI},audio_files:{_URI},share:struct<link:string>,attachments:{_NESTED}>"
_MESSAGE = f"struct<sender_name:string,timestamp_ms:string,content:string,share:struct<link:string>,photos:{_URI},videos:{_URI},audio_files:{_URI},attachments:{_NESTED}>"


def read_json_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """path, doc (variant; null for a malformed file) of all .json files."""
    x = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return x.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("doc")).where(F.col("path").endswith(".json"))


def _list(doc: str, *keys: str) -> Column:
    """The first array: the document itself, or the value of a key."""
    whole = F.schema_of_variant(F.col(doc)).startswith("ARRAY")
    out = F.when(whole, F.to_json(F.try_variant_get(F.col(doc), "$", "array<variant>")))
    for k in keys:
        out = F.coalesce(out, F.to_json(F.try_variant_get(F.col(doc), f"$.{k}", "array<variant>")))
    return out


def media_of(x: str = "x") -> tuple[Column, Column]:
    """(type, addresses): of top-level kinds the later wins; nested attachments count only without them."""
    c = lambda name: F.coalesce(F.transform(F.col(f"{x}.{name}"), lambda u: u["uri"]), F.array().cast("array<string>"))
    share = F.when(F.col(f"{x}.share.link").isNotNull(), F.array(F.col(f"{x}.share.link"))).otherwise(F.array().cast("array<string>"))
    top = F.concat(c("photos"), c("videos"), c("audio_files"), share)
    some = lambda a: F.size(a) > 0
    kind = F.when(some(share), "link").when(some(c("audio_files")), "voice").when(some(c("videos")), "video").when(some(c("photos")), "image")
    return kind, F.filter(top, lambda u: u.isNotNull() & (u != ""))


def _nested() -> tuple[Column, Column]:
    """Of an attachment's parts a medium counts before a link, a link before a voice; the last attachment's type stays."""
    part = _NESTED.removeprefix("array<struct<data:").removesuffix(">>")
    d = F.flatten(F.transform(F.coalesce(F.col("x.attachments"), F.array().cast(_NESTED)), lambda a: F.coalesce(a["data"], F.array().cast(part))))
    video = lambda u: F.contains(F.lower(F.coalesce(u, F.lit(""))), F.lit(".mp4"))
    kind = lambda e: F.when(e["media"].isNotNull(), F.when(video(e["media"]["uri"]), "video").otherwise("image")).when(e["external_context"].isNotNull(), "link").when(e["audio_file"].isNotNull(), "voice")
    uri = lambda e: F.when(e["media"].isNotNull(), e["media"]["uri"]).when(e["external_context"].isNotNull(), e["external_context"]["url"]).otherwise(e["audio_file"]["uri"])
    return F.try_element_at(F.filter(F.transform(d, kind), lambda k: k.isNotNull()), F.lit(-1)), F.filter(F.transform(d, uri), lambda u: u.isNotNull() & (u != ""))


def meta_posts(files: DataFrame) -> DataFrame:
    """post_id, post_pos, page_content, source, timestamp, content_type, media_attachments of post files (path, doc)."""
    items = _list("doc", "posts")
    no_list = F.try_variant_get("doc", "$.posts", "variant").isNotNull()
    items = F.coalesce(items, F.when(no_list, F.to_json(F.try_variant_get("doc", "$.data", "array<variant>"))))
    x = files.select("path", F.posexplode(F.from_json(items, f"array<{_POST}>")).alias("pos", "x"))
    words = F.filter(F.transform(F.coalesce("x.data", F.array().cast("array<struct<post:string>>")), lambda d: d["post"]), lambda p: p.isNotNull())
    kind, media = media_of()
    nested_kind, nested = _nested()
    x = x.select("path", "pos", text.fix_latin1(F.coalesce(F.get(words, F.size(words) - 1), F.col("x.title"))).alias("page_content"), dates.meta_epoch_to_iso(F.coalesce("x.timestamp", "x.creation_timestamp")).alias("timestamp"), F.coalesce(kind, nested_kind, F.lit("text")).alias("content_type"), F.when(kind.isNotNull(), media).otherwise(nested).alias("media_attachments"))
    x = x.where((text.pystrip(F.col("page_content")) != "") | (F.size("media_attachments") > 0))
    return x.select(text.uuid5(F.concat_ws("#", "path", F.col("pos").cast("string"))).alias("post_id"), F.struct("path", "pos").alias("post_pos"), "page_content", text.meta_source(F.col("path")).alias("source"), "timestamp", "content_type", "media_attachments")


def meta_comments(files: DataFrame) -> DataFrame:
    """comment_id, page_content, author, timestamp, target_title of comment files; empty comments are dropped."""
    x = files.select("path", F.posexplode(F.from_json(_list("doc", "comments_v2", "comments"), "array<struct<timestamp:string,title:string,data:array<struct<comment:string>>>>")).alias("pos", "x"))
    last = F.try_element_at(F.filter(F.transform(F.coalesce("x.data", F.array().cast("array<struct<comment:string>>")), lambda d: d["comment"]), lambda c: c.isNotNull()), F.lit(-1))
    x = x.withColumn("last", F.when(F.size("x.data") > 0, last))
    inner = F.get_json_object("last", "$.comment")
    body = F.coalesce(inner, F.when(~F.col("last").startswith("{"), F.col("last")), F.col("x.title"), F.lit(""))
    x = x.select(text.uuid5(F.concat_ws("#", "path", F.lit("comment"), F.col("pos").cast("string"))).alias("comment_id"), text.fix_latin1(body).alias("page_content"), text.fix_latin1(F.coalesce(F.get_json_object("last", "$.author"), F.lit("unknown"))).alias("author"), dates.meta_epoch_to_iso(F.col("x.timestamp")).alias("timestamp"), text.fix_latin1(F.col("x.title")).alias("target_title"))
    return x.where(text.pystrip(F.col("page_content")) != "")


def meta_messages(files: DataFrame) -> DataFrame:
    """thread_id, source, participants, pos (0 the earliest), sender_name, timestamp, page_content, content_type, media."""
    people = F.transform(F.from_json(F.to_json(F.try_variant_get("doc", "$.participants", "array<variant>")), "array<struct<name:string>>"), lambda p: text.fix_latin1(p["name"]))
    x = files.select("path", people.alias("participants"), F.posexplode(F.reverse(F.from_json(F.to_json(F.try_variant_get("doc", "$.messages", "array<variant>")), f"array<{_MESSAGE}>"))).alias("pos", "x"))
    kind, media = media_of()
    nested_kind, nested = _nested()
    x = x.select("path", "participants", "pos", text.fix_latin1(F.col("x.sender_name")).alias("sender_name"), dates.meta_epoch_to_iso(F.col("x.timestamp_ms")).alias("timestamp"), text.fix_latin1(F.col("x.content")).alias("page_content"), F.when(F.col("x.share").isNotNull(), "share_link").otherwise(F.coalesce(kind, nested_kind, F.lit("text"))).alias("content_type"), F.when(kind.isNotNull(), media).otherwise(nested).alias("media_attachments"))
    x = x.where((text.pystrip(F.col("page_content")) != "") | (F.size("media_attachments") > 0))
    source = text.meta_source(F.col("path"))
    source = F.when(source == "facebook", "facebook_messenger").when(source == "instagram", "instagram_direct").otherwise(source)
    return x.select(text.uuid5(F.col("path")).alias("thread_id"), source.alias("source"), "participants", "pos", "sender_name", "timestamp", "page_content", "content_type", "media_attachments")


def read_meta(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """posts (orphans' posts among them), comments with their post_id, messages."""
    files = read_json_files(spark, folder).withColumn("route", text.meta_route(F.col("path")))
    posts, comments = meta_posts(files.where("route = 'posts'")), meta_comments(files.where("route = 'comments'"))
    links = match_comments(posts, comments)
    orphans = orphan_posts(comments, links).select("post_id", "page_content", "source", "timestamp", F.lit("text").alias("content_type"), F.array().cast("array<string>").alias("media_attachments"))
    linked = comments.join(links, "comment_id").withColumn("post_id", F.coalesce("post_id", F.concat(F.lit("orphan_"), F.col("comment_id"))))
    return {"posts": posts.drop("post_pos").unionByName(orphans), "comments": linked, "messages": meta_messages(files.where("route = 'messages'"))}


_MSG = "array<struct<message_id:string,page_content:string,metadata:map<string,string>>>"
_META = "map<string,string>"
#: Shapes of rag-ready JSON: list key, schema of an element, default source.
SHAPES = {
    "messages": (f"array<struct<thread_id:string,metadata:{_META},conversation:{_MSG}>>", "chat_html"),
    "email_threads": (f"array<struct<thread_id:string,subject:string,metadata:{_META},conversation:{_MSG}>>", "gmail"),
    "posts": (f"array<struct<post_id:string,page_content:string,metadata:{_META},comments:array<struct<comment_id:string,page_content:string,metadata:{_META}>>>>", "meta_post"),
    "corpus": (f"array<struct<doc_id:string,file_name:string,page_content:string,metadata:{_META}>>", "corpus"),
}


def flatten_rag(files: DataFrame) -> DataFrame:
    """path, doc_pos, page_content, data_source, original_time, meta of every shape in every file (path, doc). A file
    with several shapes gives all of them; documents without text are skipped."""
    ids = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), F.col(v))])
    out = None

    def add(x: DataFrame, shape: str, default: Column) -> None:
        nonlocal out
        time, origin = standardized_map(F.col("meta"), default)
        x = x.where(F.col("page_content") != "").select("path", F.struct(F.lit(shape).alias("shape"), "i", "j").alias("doc_pos"), "page_content", origin.alias("data_source"), time.alias("original_time"), "meta")
        out = x if out is None else out.unionByName(x)

    for key in ("messages", "email_threads"):
        schema, default = SHAPES[key]
        t = files.select("path", F.posexplode(F.from_json(F.to_json(F.try_variant_get("doc", f"$.{key}", "array<variant>")), schema)).alias("i", "t"))
        m = t.select("path", "i", "t", F.posexplode("t.conversation").alias("j", "m"))
        add(m.select("path", "i", "j", F.col("m.page_content").alias("page_content"), merged(F.col("t.metadata"), F.col("m.metadata"), ids(thread_id="t.thread_id", message_id="m.message_id")).alias("meta")), key, F.lit(default))
    schema, default = SHAPES["posts"]
    p = files.select("path", F.posexplode(F.from_json(F.to_json(F.try_variant_get("doc", "$.posts", "array<variant>")), schema)).alias("i", "p"))
    none = F.create_map().cast(_META)
    add(p.select("path", "i", F.lit(-1).alias("j"), F.col("p.page_content").alias("page_content"), merged(none, F.col("p.metadata"), ids(post_id="p.post_id")).alias("meta")), "posts", F.lit(default))
    c = p.select("path", "i", "p", F.posexplode("p.comments").alias("j", "c"))
    add(c.select("path", "i", "j", F.col("c.page_content").alias("page_content"), merged(F.col("p.metadata"), F.col("c.metadata"), ids(post_id="p.post_id", comment_id="c.comment_id")).alias("meta")), "comments", F.lit("meta_comment"))
    schema, default = SHAPES["corpus"]
    d = files.select("path", F.posexplode(F.from_json(F.to_json(F.try_variant_get("doc", "$.corpus", "array<variant>")), schema)).alias("i", "d"))
    add(d.select("path", "i", F.lit(-1).alias("j"), F.col("d.page_content").alias("page_content"), merged(none, F.col("d.metadata"), ids(doc_id="d.doc_id")).alias("meta")), "corpus", F.lit(default))
    one = f"struct<page_content:string,metadata:{_META}>"
    whole = F.schema_of_variant("doc").startswith("ARRAY")
    lists = files.where(whole).select("path", F.posexplode(F.from_json(F.to_json(F.try_variant_get("doc", "$", "array<variant>")), f"array<{one}>")).alias("i", "x"), F.lit("unknown_list").alias("kind"))
    single = files.where(~whole & F.try_variant_get("doc", "$.page_content", "string").isNotNull()).select("path", F.lit(0).alias("i"), F.from_json(F.to_json("doc"), one).alias("x"), F.lit("unknown_single").alias("kind"))
    add(lists.unionByName(single).select("path", "i", F.lit(-1).alias("j"), "kind", F.col("x.page_content").alias("page_content"), F.coalesce("x.metadata", none).alias("meta")), "list", F.col("kind"))
    return out
