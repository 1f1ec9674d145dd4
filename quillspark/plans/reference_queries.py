"""The registered queries of the engine's own operators over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import chunking, ingest, masking, threads
from ..session import table
from ..sources import chats, exports, mail

QUERIES: dict = {}
SQL: dict[str, str] = {}
_BLANK = r"[\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ME = {"me.ashdene@postern.example": masking.ME, "Corwin Gorsedene": masking.ME}
WORDS = {"Lindwurm Verlag": "[REDACTED_COMPANY]", "Tarn & Vale": "[REDACTED_COMPANY]", "Alder Quay": "[REDACTED_ADDRESS]"}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def subject(x: str) -> str:
    bare = strip(f"regexp_replace({strip(x)}, '^(?:(?i:re|fwd|fw|回覆|轉寄){_BLANK}*[:：]{_BLANK}*)+', '')")
    return f"case when {x} is null or {bare} = '' then 'No Subject' else {bare} end"


def any_of(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, {q(w)})" for w in words) + ")"


_clean = strip(r"regexp_replace(regexp_replace(text, '\n+', chr(10), 'g'), '[ \t]+', ' ', 'g')")


@query(f"select doc_id, {_clean} as cleaned from documents where {_clean} <> ''")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned")).where("cleaned <> ''")


@query("select doc_id, case " + " ".join(f"when {any_of('lower(file_name)', w)} then '{k}'" for k, w in text.DOC_TYPES) + " else 'general' end as kind from documents")
def doc_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.coalesce(text.doc_type(F.col("file_name")), F.lit("general")).alias("kind"))


@query(r"select doc_id, string_split(file_name, '/')[-1] as base, lower(regexp_extract(string_split(file_name, '/')[-1], '.\.([^.]*)$', 1)) as ext, regexp_replace(string_split(file_name, '/')[-1], '(.)\.[^.]*$', '\1') as stem from documents where file_name is not null")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    f = F.col("file_name")
    return table(spark, d, "documents").where("file_name is not null").select("doc_id", text.basename(f).alias("base"), text.extension(f).alias("ext"), text.stem(f).alias("stem"))


_path = "coalesce(source, 'other') || '_data/' || case when content_type = 'video' then 'inbox' else 'x' end || '/' || case when content_type = 'image' then 'comments' else 'posts' end || '_1.json'"


@query(f"""select post_no, case when source in ('facebook', 'instagram', 'threads') then source else 'unknown' end as meta_source,
case when content_type = 'video' then 'messages' when content_type = 'image' then 'comments' else 'posts' end as route from (select *, {_path} as path from meta_posts)""")
def meta_routes(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "meta_posts").withColumn("path", F.expr(_path))
    return x.select("post_no", text.meta_source(F.col("path")).alias("meta_source"), text.meta_route(F.col("path")).alias("route"))


@query(f"select msg_no, {subject('subject')} as subject_clean, md5({subject('subject')}) as thread_key from message_data")
def subject_threads(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "message_data").select("msg_no", text.clean_subject(F.col("subject")).alias("subject_clean")).withColumn("thread_key", F.md5("subject_clean"))


_openers = q(r"^(?:(?i:On\s+.+?wrote:$)|(?i:-{3,}\s*Original Message\s*-{3,})|_{3,}$|(?i:From:\s+.*<.+@.+>))")
_devices = q(r"^(?i:Sent from my (?:iPhone|iPad|Android)|從我的\s*(?:iPhone|iPad|Android)\s*傳送)")


@query(f"""with a as (select msg_no, list_transform(string_split(page_content, chr(10)), lambda x: {strip("x")}) as l from message_data where page_content is not null),
b as (select msg_no, l, list_position(list_transform(l, lambda x: regexp_matches(x, {_openers})), true) as p from a),
c as (select msg_no, list_filter(case when p > 0 then list_slice(l, 1, p - 1) else l end, lambda x: not starts_with(x, '>') and not regexp_matches(x, {_devices})) as k from b)
select msg_no, regexp_replace({strip("coalesce(array_to_string(k, chr(10)), '')")}, '\\n{{3,}}', chr(10) || chr(10), 'g') as body from c where {strip("coalesce(array_to_string(k, chr(10)), '')")} <> ''""")
def email_bodies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "message_data").select("msg_no", text.clean_body(F.col("page_content")).alias("body")).where("body <> ''")


def _masked_sql(x: str) -> str:
    octet = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
    around = [(rf"(?:{octet}\.){{3}}{octet}", "[^0-9]", "[^0-9]", "[REDACTED_IP]"), None, None, None, None, (r"[A-Za-z][1289][0-9]{8}", "[^A-Za-z0-9]", "[^0-9]", "[REDACTED_ID]"), (r"[0-9]{8}", "[^0-9]", "[^0-9]", "[REDACTED_ID]")]
    for (pattern, tag), a in zip(masking.RULES, around, strict=True):
        if a:
            for _ in range(2):
                x = f"regexp_replace({x}, {q(f'(^|{a[1]})(?:{a[0]})({a[2]}|$)')}, '\\1{a[3]}\\2', 'g')"
        else:
            x = f"regexp_replace({x}, {q(pattern.removeprefix('(?U)'))}, '{tag}', 'g')"
    return x


@query(f"select id, case when {strip('raw_content')} = '' then raw_content else {_masked_sql('raw_content')} end as masked from writing_style_logs")
def mask_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "writing_style_logs").select("id", masking.mask_text(F.col("raw_content")).alias("masked"))


def _replaced(x: str) -> str:
    for k, v in [*ME.items(), *WORDS.items()]:
        x = f"replace({x}, {q(k)}, {q(v)})"
    return x


@query(f"select msg_no, case when {strip('page_content')} = '' then page_content else {_replaced('page_content')} end as masked from message_data")
def mask_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "message_data").select("msg_no", masking.mask_text(F.col("page_content"), ME, WORDS, []).alias("masked"))


@query()
def masked_messages(spark: SparkSession, d: str) -> DataFrame:
    """Every text column of the messages masked, senders and receivers by one numbering in their thread; ids and times verbatim."""
    x = masking.with_speakers(table(spark, d, "message_data"), "thread_id", ["sender", "receiver"], ["msg_no"], list(ME), ["sender", "receiver"])
    return masking.mask_columns(x, ME, WORDS)


@query(f"""with c as (select chat_no, thread_id, {strip("sender_name")} as nm from chat_messages),
f as (select thread_id, nm, min(chat_no) as f from c where nm is not null and nm <> 'Unknown' group by all),
n as (select *, row_number() over (partition by thread_id order by f) as n from f)
select c.chat_no, case when c.nm = 'Unknown' then '[AUTHOR_ME]' when n.n is not null then '[SPEAKER_' || n.n || ']' end as speaker_tag
from c left join n on c.thread_id is not distinct from n.thread_id and c.nm = n.nm""")
def speaker_tracking(spark: SparkSession, d: str) -> DataFrame:
    return masking.with_speakers(table(spark, d, "chat_messages"), "thread_id", "sender_name", ["chat_no"], ["Unknown"]).select("chat_no", "speaker_tag")


@query(f"select md5(s) as thread_key, count(*) as total_messages from (select *, {subject('subject')} as s from message_data) group by s having coalesce(bool_or(is_me), false)")
def my_threads(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "message_data").select(text.clean_subject(F.col("subject")).alias("subject_clean"), "is_me")
    return threads.thread_summary(x).where("mine").select("thread_key", "total_messages")


@query(f"select count(*) filter (where mine) as retained, count(*) filter (where not mine) as filtered from (select coalesce(bool_or(is_me), false) as mine from (select *, {subject('subject')} as s from message_data) group by s)")
def thread_counts(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "message_data").select(text.clean_subject(F.col("subject")).alias("subject_clean"), "is_me")
    return threads.thread_summary(x).agg(F.count_if("mine").alias("retained"), F.count_if(~F.col("mine")).alias("filtered"))


@query("select msg_no, row_number() over (partition by thread_id order by coalesce(timestamp, ''), msg_no) - 1 as position from message_data")
def thread_order(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "message_data").select("msg_no", "thread_id", F.coalesce("timestamp", F.lit("")).alias("t"))
    days = [F.substring("t", 1, 10), F.struct("t", F.floor(F.col("msg_no") / 4096))]  # one time text may be that of a third of all rows
    return threads.numbered(x, ["thread_id"], days, ["t", "msg_no"]).select("msg_no", "position")


@query("select chat_no, row_number() over (partition by thread_id order by chat_no desc) - 1 as position from chat_messages")
def thread_reverse(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "chat_messages").select("chat_no", "thread_id", (-F.col("chat_no")).alias("back"))
    return threads.numbered(x, ["thread_id"], F.floor(F.col("back") / 4096), ["back"]).select("chat_no", "position")


@query("select event_id, coalesce(last_value(case when event_type in ('signup', 'purchase') then event_type end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding), 'Unknown') as state from events")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "events").select("event_id", "user_id", F.expr("case when event_type in ('signup', 'purchase') then event_type end").alias("v"))
    return threads.carried_forward(x, ["user_id"], F.floor(F.col("event_id") / 4096), "event_id", "v", "Unknown", "state").select("event_id", "state")


_low = "lower(" + strip("regexp_replace(page_content, '[\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{feff}]+', '', 'g')") + ")"
_sniffed = "case when content_type in ('text', 'link') then case " + " ".join(f"when {any_of(_low, w)} then '{k}'" for k, w in text.MEDIA_TEXTS) + " else content_type end else content_type end"


@query(f"select chat_no, {_sniffed} as sniffed from chat_messages")
def content_type_sniff(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_messages").select("chat_no", text.sniff_type(F.col("content_type"), F.col("page_content")).alias("sniffed"))


@query(f"""select chat_no from (select *, {_sniffed} as k, coalesce(page_content, '') as c, coalesce(sender_name, '') as s from chat_messages)
where coalesce(k, '') not in ('image', 'video', 'voice') and {strip("c")} <> '' and not contains(lower(c), 'html') and not contains(s, 'Line 銀行') and s <> 'LINE購物'""")
def chat_kept(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "chat_messages")
    return x.where(text.keep_chat(text.sniff_type(F.col("content_type"), F.col("page_content")), F.col("page_content")) & text.not_spam(F.col("sender_name"))).select("chat_no")


@query(r"select chat_no, case when contains(lower(source_file), 'line') then 'line' when contains(lower(source_file), 'whatsapp') then 'whatsapp' else 'unknown' end as found, regexp_replace(source_file, '(.)\.[^.]*$', '\1') as thread_name from chat_messages")
def chat_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_messages").select("chat_no", text.chat_source(F.col("source_file")).alias("found"), text.stem(F.col("source_file")).alias("thread_name"))


def _links(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meta_posts")
    posts = m.select(F.col("post_no").alias("post_id"), F.col("post_no").alias("post_pos"), "page_content")
    return threads.match_comments(posts, m.select(F.col("post_no").alias("comment_id"), F.concat(F.lit("Re: "), "page_content").alias("target_title")))


_match = "select c.post_no as comment_id, min(p.post_no) as post_id from meta_posts c left join meta_posts p on p.page_content <> '' and contains('Re: ' || c.page_content, left(p.page_content, 20)) group by c.post_no"


@query(_match)
def comment_post_match(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


@query(f"select post_id, count(*) as comments, min(comment_id) as first_comment from ({_match}) where post_id is not null group by post_id")
def comments_of_posts(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).where("post_id is not null").groupBy("post_id").agg(F.count("*").alias("comments"), F.min("comment_id").alias("first_comment"))


@query("select 'orphan_' || m.msg_no as post_id, 'Orphaned Comment' as page_content, 'comments' as source, m.timestamp from message_data m where not exists (select 1 from meta_posts p where p.page_content <> '' and contains(m.subject, left(p.page_content, 20)))")
def orphan_comments(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "meta_posts").select(F.col("post_no").alias("post_id"), F.col("post_no").alias("post_pos"), "page_content")
    comments = table(spark, d, "message_data").select(F.col("msg_no").alias("comment_id"), F.col("subject").alias("target_title"), "timestamp")
    return threads.orphan_posts(comments, threads.match_comments(posts, comments))


@query("select doc_id, md5(file_name) as path_id from documents")
def doc_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5("file_name").alias("path_id"))


@query("select chat_no, regexp_replace(coalesce(message_id, 'msg_' || md5(coalesce(thread_id, '') || coalesce(timestamp, ''))), '^[<>]+|[<>]+$', '', 'g') as message_key from chat_messages")
def message_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_messages").select("chat_no", text.message_key(F.col("message_id"), F.col("thread_id"), F.col("timestamp")).alias("message_key"))


@query()
def chunk_uuid5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "writing_style_logs").select("id", text.uuid5(F.concat_ws("-", "file_name", F.col("chunk_index").cast("string"))).alias("chunk_id"))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").where("text is not null").select("doc_id", "file_name", "text")
    return chunking.chunked(x, "text", "file_name", "doc_id", F.floor(F.col("doc_id") / 4096))


@query("select id, cast(row_number() over (partition by file_name order by id) - 1 as int) as chunk_index from writing_style_logs where raw_content is not null and not coalesce(is_noise, false)")
def chunk_index(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that are no noise, numbered anew over their file."""
    x = table(spark, d, "writing_style_logs").where("raw_content is not null and not coalesce(is_noise, false)").select("id", "file_name")
    return threads.numbered(x, ["file_name"], F.floor(F.col("id") / 4096), ["id"], "chunk_index").select("id", F.col("chunk_index").cast("int").alias("chunk_index"))


@query()
def chunk_all(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("doc_id", "file_name", "chunk_index", "raw_content", "content_hash")


@query(f"select doc_id, {strip('text')} as raw_content, sha256({strip('text')}) as content_hash from documents where length(text) <= 800 and {strip('text')} <> ''")
def chunk_short(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of all documents that are no longer than a chunk; of the longer ones, see `chunk_all`."""
    x = _chunks(spark, d).join(table(spark, d, "documents").where("length(text) <= 800").select("doc_id"), "doc_id", "left_semi")
    return x.select("doc_id", "raw_content", "content_hash")


@query("select id, sha256(raw_content) as sha, coalesce(sha256(raw_content) = content_hash, false) as agrees from writing_style_logs")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    sha = F.sha2("raw_content", 256)
    return table(spark, d, "writing_style_logs").select("id", sha.alias("sha"), F.coalesce(sha == F.col("content_hash"), F.lit(False)).alias("agrees"))


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The table as it was, and a later run: first chunks were changed, and each file's repeated chunks are new ones."""
    x = table(spark, d, "writing_style_logs").where("file_name is not null and chunk_index is not null")
    old = x.groupBy("file_name", "chunk_index").agg(F.min("content_hash").alias("content_hash"))
    new = old.where("chunk_index = 0").select("file_name", "chunk_index", F.sha2(F.col("content_hash"), 256).alias("content_hash")).unionByName(old.where("chunk_index > 0")).unionByName(old.where("chunk_index = 1").select("file_name", (F.col("chunk_index") + 5000).alias("chunk_index"), "content_hash"))
    return old, new


_old = "old as (select file_name, chunk_index, min(content_hash) as content_hash from writing_style_logs where file_name is not null and chunk_index is not null group by all)"
_new = "new as (select file_name, chunk_index, sha256(content_hash) as content_hash from old where chunk_index = 0 union all select * from old where chunk_index > 0 union all select file_name, chunk_index + 5000, content_hash from old where chunk_index = 1)"


@query(f"with {_old}, {_new} select n.* from new n left join old o using (file_name, chunk_index) where n.content_hash is distinct from o.content_hash")
def incremental_diff(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    return ingest.changed(new, old).select("file_name", "chunk_index", "content_hash")


@query(f"with {_old}, {_new} select file_name, chunk_index, case when n.file_name is not null then n.content_hash else o.content_hash end as content_hash from old o full join new n using (file_name, chunk_index)")
def upsert_chunks(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    return ingest.upserted(old, ingest.changed(new, old)).select("file_name", "chunk_index", "content_hash")


@query(f"with {_old}, {_new} select * from old union all select n.* from new n anti join old o using (file_name, chunk_index)")
def append_new_chunks(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    return ingest.appended(old, new).select("file_name", "chunk_index", "content_hash")


@query(f"with {_old}, m as (select file_name, max(chunk_index) as m from old where chunk_index < 3 group by file_name) select o.* from old o join m using (file_name) where chunk_index > m")
def stale_chunks(spark: SparkSession, d: str) -> DataFrame:
    old, _ = _versions(spark, d)
    return ingest.stale_chunks(old, old.where("chunk_index < 3")).select("file_name", "chunk_index", "content_hash")


_meta = """concat('{"timestamp": "', event_id, '"', case when event_type = 'error' then ', "original_time": null' when event_type = 'signup' then ', "original_time": "x"' else '' end, case when event_type = 'purchase' then ', "source": null' when event_type = 'click' then ', "source": "web"' else '' end, case when value > 150 then ', "data_source": "api"' else '' end, '}')"""


@query("""select event_id, case when event_type = 'error' then null when event_type = 'signup' then 'x' else cast(event_id as varchar) end as original_time,
case when value > 150 then 'api' when event_type = 'purchase' then null when event_type = 'click' then 'web' else 'gmail' end as data_source from events""")
def metadata_standardize(spark: SparkSession, d: str) -> DataFrame:
    time, origin = ingest.standardized(F.col("meta"), "source", "gmail")
    return table(spark, d, "events").withColumn("meta", F.expr(_meta)).select("event_id", time.alias("original_time"), origin.alias("data_source"))


@query("select post_no, 'comment' as kind, page_content, coalesce(source, 'x') as data_source, timestamp as original_time from meta_posts where page_content <> '' union all select post_no, 'post', page_content, source, timestamp from meta_posts where page_content <> ''")
def flatten_posts(spark: SparkSession, d: str) -> DataFrame:
    """Each post as rag-ready JSON with itself as a comment, and flattened again."""
    none = F.create_map(F.lit("timestamp"), "timestamp", F.lit("source"), "source")
    mine = F.create_map(F.lit("timestamp"), F.col("timestamp"), F.lit("source"), F.coalesce("source", F.lit("x")))
    comment = F.array(F.struct(F.lit("c").alias("comment_id"), "page_content", mine.alias("metadata")))
    doc = F.to_json(F.struct(F.array(F.struct(F.col("post_id"), F.col("page_content"), none.alias("metadata"), comment.alias("comments"))).alias("posts")), {"ignoreNullFields": "false"})
    files = table(spark, d, "meta_posts").select(F.col("post_no").cast("string").alias("path"), F.parse_json(doc).alias("doc"))
    x = exports.flatten_rag(files)
    return x.select(F.col("path").cast("long").alias("post_no"), F.when(F.col("doc_pos.shape") == "comments", "comment").otherwise("post").alias("kind"), "page_content", "data_source", "original_time")


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') as meta_iso from events")
def epoch_to_iso(spark: SparkSession, d: str) -> DataFrame:
    s = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", dates.epoch_to_iso(s).alias("iso"), dates.meta_epoch_to_iso(F.when(F.col("event_id") % 2 == 0, s).otherwise(s * 1000)).alias("meta_iso"))


_three = r"regexp_full_match(timestamp, '\d{4}(/\d{1,2}/\d{1,2} |-\d{1,2}-\d{1,2}[ T])\d{1,2}:\d{1,2}:\d{1,2}')"


@query(f"select msg_no, case when {_three} then try_strptime(replace(replace(timestamp, '/', '-'), 'T', ' '), '%Y-%m-%d %H:%M:%S') end as original_time from message_data")
def parse_original_time(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "message_data").select("msg_no", dates.parse_original_time_compat(F.col("timestamp")).cast("timestamp_ntz").alias("original_time"))


@query()
def parse_original_time_all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "message_data").select("msg_no", dates.parse_original_time(F.col("timestamp")).alias("original_time"))


_zones = {"GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
_bare = r"regexp_replace(regexp_replace(trim(timestamp), '^[A-Za-z]{3},\s*', ''), '\s*\([^)]*\)$', '')"
for _z, _o in _zones.items():
    _bare = rf"regexp_replace({_bare}, '\s{_z}$', ' {_o}')"
_rfc = r"regexp_full_match(b, '\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}')"


@query(f"select msg_no, coalesce(case when {_rfc} then strftime(try_strptime(b, '%d %b %Y %H:%M:%S %z') at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') end, '') as iso from (select msg_no, {_bare} as b from message_data)")
def rfc2822_to_iso(spark: SparkSession, d: str) -> DataFrame:
    """All rows: the usual shape of a mail's date, with abbreviations and comments; other texts give ''."""
    return table(spark, d, "message_data").select("msg_no", dates.usual_rfc2822_to_iso(F.col("timestamp")).alias("iso"))


@query()
def rfc2822_to_iso_all(spark: SparkSession, d: str) -> DataFrame:
    """All rows, whatever a mail reader takes for a date."""
    return table(spark, d, "message_data").select("msg_no", dates.rfc2822_to_iso(F.col("timestamp")).alias("iso"))


@query("select doc_id, cast(floor((row_number() over (order by doc_id) - 1) / 100) as bigint) as batch_no from documents")
def batch_number(spark: SparkSession, d: str) -> DataFrame:
    return ingest.batch_numbers(table(spark, d, "documents").select("doc_id"), 100, "doc_id", [F.floor(F.col("doc_id") / (1 << 24)), F.floor(F.col("doc_id") / 4096)])


@query("select count(*) as total_read, count(*) filter (where raw_content is not null and is_noise) as noise_filtered, count(*) filter (where raw_content is null) as processing_errors, count(*) filter (where raw_content is not null and not coalesce(is_noise, false)) as kept from writing_style_logs")
def ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    return ingest.run_metrics(table(spark, d, "writing_style_logs").select("is_noise", F.when(F.col("raw_content").isNull(), "no text").alias("error")))


@query("select id from writing_style_logs where raw_content is not null and not coalesce(is_noise, false)")
def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "writing_style_logs").where("raw_content is not null and not coalesce(is_noise, false)").select("id")


@query("select distinct file_name from writing_style_logs where file_name is not null and file_name not in (select file_name from documents where file_name is not null)")
def unseen_files(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "writing_style_logs").where("file_name is not null").select("file_name").distinct()
    return x.join(table(spark, d, "documents").select("file_name").distinct(), "file_name", "left_anti")


@query(f"""select chat_no, {strip("coalesce(sender_name, '')")} as sender, {strip("coalesce(timestamp, '')")} as t, {strip("coalesce(page_content, '')")} as body from (select *, case when {any_of(_low.replace('page_content', "coalesce(page_content, '')"), [w for _, ws in text.MEDIA_TEXTS for w in ws])} then 'm' else 't' end as k from chat_messages)
where k = 't' and {strip("coalesce(page_content, '')")} <> '' and not contains(lower(page_content), 'html') and not contains(coalesce(sender_name, ''), 'Line 銀行')""")
def chat_html(spark: SparkSession, d: str) -> DataFrame:
    """Each message as a page of chat HTML, read by the parser of such pages."""
    x = table(spark, d, "chat_messages").select(F.col("chat_no").cast("string").alias("file"), chats.markup_of(F.col("sender_name"), F.col("timestamp"), F.col("page_content")).alias("markup"))
    return chats.chat_messages(x).select(F.col("file").cast("long").alias("chat_no"), F.col("sender_name").alias("sender"), F.col("timestamp").alias("t"), F.col("page_content").alias("body"))


_line_sql = f"""select chat_no, 'line' as source, case when {strip("coalesce(sender_name, '')")} = '' then 'Unknown' else {strip("sender_name")} end as sender, case when regexp_matches({strip("coalesce(timestamp, '')")}, '[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}') then {strip("timestamp")} else '' end as t, {strip("coalesce(page_content, '')")} as body
from (select *, case when {any_of(_low.replace('page_content', "coalesce(page_content, '')"), [w for _, ws in text.MEDIA_TEXTS for w in ws])} then 'm' else 't' end as k from chat_messages)
where k = 't' and {strip("coalesce(page_content, '')")} <> '' and not contains(lower(page_content), 'html') and not contains(coalesce(sender_name, ''), 'Line 銀行') and {strip("coalesce(sender_name, '')")} <> 'LINE購物'"""


@query(_line_sql)
def chat_html_line(spark: SparkSession, d: str) -> DataFrame:
    """Each message as a LINE page with a date, a sender, a line that is no message, and a table that is one."""
    x = table(spark, d, "chat_messages").select(F.concat(F.lit("line_"), F.col("chat_no").cast("string")).alias("file"), chats.line_markup_of(F.col("sender_name"), F.col("timestamp"), F.col("page_content")).alias("markup"))
    return chats.chat_messages(x).select(F.substring_index("file", "_", -1).cast("long").alias("chat_no"), "source", F.col("sender_name").alias("sender"), F.col("timestamp").alias("t"), F.col("page_content").alias("body"))


@query("select post_no, case when source = 'facebook' then 'facebook_messenger' when source = 'instagram' then 'instagram_direct' when source = 'threads' then 'threads' else 'unknown' end as source, case when contains(lower(u), '.mp4') then 'video' else 'image' end as content_type, u as medium from (select post_no, source, 'a/' || post_no || case when content_type = 'video' then '.MP4?x' else '.jpg' end as u from meta_posts)")
def meta_message_media(spark: SparkSession, d: str) -> DataFrame:
    """Each post as a message whose medium stands in an attachment, without text, read by the exports' parser."""
    m = table(spark, d, "meta_posts")
    uri = F.concat(F.lit("a/"), F.col("post_no").cast("string"), F.when(F.col("content_type") == "video", ".MP4?x").otherwise(".jpg"))
    part = F.struct(F.array(F.struct(F.struct(uri.alias("uri")).alias("media"), F.struct(F.lit("http://x.test").alias("url")).alias("external_context"))).alias("data"))
    doc = F.to_json(F.struct(F.array(F.struct(F.lit("Ann").alias("name"))).alias("participants"), F.array(F.struct(F.lit("Ann").alias("sender_name"), F.lit(1).alias("timestamp_ms"), F.array(part).alias("attachments"))).alias("messages")))
    files = m.select(F.concat(F.coalesce("source", F.lit("x")), F.lit("_data/inbox/"), F.col("post_no").cast("string"), F.lit(".json")).alias("path"), F.parse_json(doc).alias("doc"), "post_no")
    keys = files.select(text.uuid5(F.col("path")).alias("thread_id"), "post_no")
    return exports.meta_messages(files).join(keys, "thread_id").select("post_no", "source", "content_type", F.explode("media_attachments").alias("medium"))


@query()
def mime_messages(spark: SparkSession, d: str) -> DataFrame:
    """Each e-mail as the bytes of a message, read by the parser of mailboxes."""
    x = table(spark, d, "message_data").where("page_content is not null")
    head = F.concat(F.lit("Subject: "), F.regexp_replace(F.coalesce("subject", F.lit("")), r"[\r\n]+", " "), F.lit("\nDate: "), F.regexp_replace(F.coalesce("timestamp", F.lit("")), r"[^\x20-\x7e]+", " "), F.lit("\nFrom: "), F.coalesce("sender", F.lit("")), F.lit("\nTo: "), F.coalesce("receiver", F.lit("")), F.lit("\nMessage-ID: <"), F.coalesce("message_id", F.lit("")), F.lit(">\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"))
    raw = F.concat(F.encode(head, "UTF-8"), F.encode(F.base64(F.encode("page_content", "UTF-8")), "UTF-8"))
    return mail.message_rows(x.select(F.col("source_file").alias("file"), F.col("msg_no").alias("msg_idx"), raw.alias("raw")), "me.ashdene@postern.example")


@query()
def meta_exports(spark: SparkSession, d: str) -> DataFrame:
    """Each post as an export file of social media, read by its parser; misread UTF-8 is put right."""
    m = table(spark, d, "meta_posts")
    doc = F.to_json(F.array(F.struct(F.unix_seconds("loaded_at").alias("timestamp"), F.array(F.struct(F.col("page_content").alias("post"))).alias("data"), F.transform("media_attachments", lambda u: F.struct(u.alias("uri"))).alias("photos"))))
    files = m.select(F.concat(F.coalesce("source", F.lit("x")), F.lit("_data/posts_"), "post_no", F.lit(".json")).alias("path"), F.parse_json(doc).alias("doc"))
    return exports.meta_posts(files).select("post_id", "page_content", "source", "timestamp", "content_type", "media_attachments")


@query()
def latin1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meta_posts").select("post_no", text.fix_latin1(F.col("page_content")).alias("repaired"))


@query()
def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows fit for the chunk table, from whole documents."""
    x = _chunks(spark, d).select("file_name", "raw_content", "content_hash", "chunk_index", F.lit("corpus").alias("data_source"), F.lit("text").alias("content_category"), F.lit(0.5).alias("information_weight"))
    return ingest.validated(x)[0]
