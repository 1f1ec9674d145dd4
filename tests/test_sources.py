import io
import json
import mailbox
import zipfile
from email.message import EmailMessage

from quillspark.plans.pipeline import PipelineConfig, run
from quillspark.sources import chats, exports, mail, office, sinks
from quillspark.streaming.files import ingest_new_files
from pyspark.sql import functions as F


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return b.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'


def test_office(spark, tmp_path):
    (tmp_path / "論文").mkdir()
    (tmp_path / "論文" / "a.TXT").write_bytes(b"bad \xff byte\n\n\nend")
    cell = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    (tmp_path / "diary.docx").write_bytes(zipped(**{"word/document.xml": f"<w:document {W}><w:body><w:p><w:r><w:t>one</w:t></w:r><w:r><w:t>two</w:t></w:r></w:p><w:p/>{cell}</w:body></w:document>"}))
    slide = lambda t: f"<p:sld {A}><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sld>"
    (tmp_path / "x.pptx").write_bytes(zipped(**{"ppt/slides/slide10.xml": slide("last"), "ppt/slides/slide2.xml": slide("first")}))
    (tmp_path / "scan.pdf").write_bytes(b"%PDF")
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "empty.txt").write_bytes(b"  \n ")
    got = {r.file_name: r for r in office.read_office(spark, str(tmp_path), ocr=lambda b, e: "read by eye").collect()}
    assert got["a.TXT"].page_content == "bad � byte\nend" and got["a.TXT"].doc_type == "academic_paper" and got["a.TXT"].relative_path == "論文/a.TXT"
    assert got["diary.docx"].page_content == "onetwo\ncell" and got["diary.docx"].doc_type == "journal_diary"
    assert got["x.pptx"].page_content == "first\nlast"
    assert got["scan.pdf"].is_ocr and got["scan.pdf"].page_content == "read by eye"
    assert got["broken.docx"].error and "empty.txt" not in got


def test_mbox(spark, tmp_path):
    box = mailbox.mbox(str(tmp_path / "a.mbox"))
    for k, (subject, body) in enumerate([("Re: =?utf-8?b?5pyD6K2w?=", "Hello\nFrom the start\n> old\nSent from my iPad"), ("x", ""), ("", "only text")]):
        m = EmailMessage()
        m["Subject"], m["Date"], m["From"], m["To"] = subject, "Wed, 12 Mar 2014 10:00:00 +0800", "Ann <ME@x.test>", "b@x.test"
        m["Message-ID"] = f"<id{k}@x>"
        m.set_content(body)
        box.add(m)
    box.flush()
    spark.dataSource.register(mail.MboxSource)
    raw = spark.read.format("mbox").option("path", str(tmp_path)).load()
    assert raw.count() == 3
    got = sorted(mail.message_rows(raw, "me@x.test").collect(), key=lambda r: r.msg_idx)
    assert [(r.subject, r.page_content, r.message_id, r.is_me, r.timestamp) for r in got] == [("會議", "Hello\nFrom the start", "id0@x", True, "2014-03-12T02:00:00Z"), ("No Subject", "only text", "id2@x", True, "2014-03-12T02:00:00Z")]


def test_chats(spark, tmp_path):
    line = '<html><title>x</title><nav>menu</nav><div class="content"><p align="left">TO: Family</p><p class="triangle-left">early</p><p>no message</p><p align="left" class="x">none</p><p align="center">2024/01/02</p><p align="left">Ann</p><p class="triangle">hi <b>there</b></p><p align="left">LINE購物</p><p class="triangle">buy</p><p align="left">Bob</p><table class="triangle"><tr><td>yes</td></tr></table><p class="triangle">[貼圖]</p><p class="triangle"><img src="a.png"></p></div></html>'
    (tmp_path / "line_1.HTML").write_text(line)
    (tmp_path / "whatsapp.html").write_text('<title>Trip</title><div class="msg"><span class="sender">Ann</span> 10:00 <p class="text">see <a href="http://x.test">here</a></p></div><div class="message">Unknown hello</div>')
    got = sorted(((r.source, r.thread_id, r.sender_name, r.timestamp, r.page_content, r.content_type) for r in chats.read_chats(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([
        ("line", "Family", "Unknown", "", "early", "text"), ("line", "Family", "Ann", "2024/01/02", "hi there", "text"), ("line", "Family", "Bob", "2024/01/02", "yes", "text"),
        ("whatsapp", "Trip", "Ann", "", "see here", "link"), ("whatsapp", "Trip", "Unknown", "", "hello", "text"),
    ], key=str)


def test_meta_exports(spark, tmp_path):
    base = tmp_path / "facebook_data"
    (base / "inbox").mkdir(parents=True)
    moji = "價格".encode().decode("latin-1")
    (base / "your_posts.json").write_text(json.dumps([{"timestamp": 1500000000, "data": [{"post": "old"}, {"post": moji}]}, {"title": "with picture", "photos": [{"uri": "p.jpg"}, {"uri": ""}], "videos": [{"uri": "v.mp4"}]}, {"timestamp": 1}, {"attachments": [{"data": [{"media": {"uri": "m.mp4"}}, {"external_context": {"url": "http://x"}}]}]}]))
    (base / "comments.json").write_text(json.dumps({"comments_v2": [{"timestamp": 1, "title": f"Ann on {moji} x", "data": [{"comment": {"comment": "good", "author": "Ann"}}]}, {"timestamp": 2, "title": "lost", "data": [{"comment": "as text"}]}, {"timestamp": 3, "title": "", "data": []}]}))
    (base / "inbox" / "message_1.json").write_text(json.dumps({"participants": [{"name": "Ann"}], "messages": [{"sender_name": "Ann", "timestamp_ms": 1500000000123, "content": "late"}, {"sender_name": "Bob", "timestamp_ms": 5, "content": "early", "share": {"link": "http://y"}}, {"sender_name": "Bob"}]}))
    (base / "broken_posts.json").write_text("{")
    got = exports.read_meta(spark, str(tmp_path))
    posts = {r.page_content: r for r in got["posts"].collect()}
    assert set(posts) == {"價格", "with picture", "", "Orphaned Comment"} and posts["with picture"].content_type == "video" and posts["with picture"].media_attachments == ["p.jpg", "v.mp4"] and posts[""].content_type == "link"
    comments = {r.page_content: r for r in got["comments"].collect()}
    assert comments["good"].author == "Ann" and comments["good"].post_id == posts["價格"].post_id and comments["as text"].post_id == posts["Orphaned Comment"].post_id
    m = sorted(got["messages"].collect(), key=lambda r: r.pos)
    assert [(r.sender_name, r.page_content, r.content_type, r.source) for r in m] == [("Bob", "early", "share_link", "facebook_messenger"), ("Ann", "late", "text", "facebook_messenger")]


def judge():
    class Judge:  # local, so that workers get it by value
        def analyze(self, texts):
            return [{"is_noise": "noise" in t, "generated_tags": [], "content_category": "c", "information_weight": 0.5} for t in texts]

    return Judge()


def config(tmp_path):
    return PipelineConfig(str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "dead"))


def write(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    doc = {"messages": [], "posts": [{"post_id": "p", "page_content": text, "metadata": {"timestamp": None, "source": "fb"}, "comments": [{"comment_id": "c", "page_content": "noise", "metadata": {}}]}], "corpus": [{"doc_id": "d", "file_name": "f", "page_content": "word " * 400, "metadata": {"created_at": "2024-01-02T03:04:05Z"}}]}
    (tmp_path / "in" / name).write_text(json.dumps(doc))


def test_whole_runs_are_idempotent(spark, tmp_path):
    write(tmp_path, "a.json", "hello 12345678")
    m = run(spark, config(tmp_path), judge()).first()
    assert (m.total_read, m.noise_filtered, m.kept) == (3, 1, 2)
    table = sinks.ChunkTable(spark, str(tmp_path / "table"))
    first = {(r.chunk_index, r.content_hash, r.created_at) for r in table.read().collect()}
    assert sorted(x[0] for x in first) == [0, 1, 2, 3]
    run(spark, config(tmp_path), judge())
    assert {(r.chunk_index, r.content_hash, r.created_at) for r in table.read().collect()} == first
    texts = [r.raw_content for r in table.read().collect()]
    assert "hello [REDACTED_ID]" in texts


def test_stream_reads_new_files_only(spark, tmp_path):
    seen = []

    table = sinks.ChunkTable(spark, str(tmp_path / "table"))
    write(tmp_path, "a.json", "one")
    ingest_new_files(spark, config(tmp_path), judge(), str(tmp_path / "state"))
    seen.append(table.read().count())
    write(tmp_path, "b.json", "two")
    ingest_new_files(spark, config(tmp_path), judge(), str(tmp_path / "state"))
    seen.append(table.read().count())
    ingest_new_files(spark, config(tmp_path), judge(), str(tmp_path / "state"))
    seen.append(table.read().count())
    assert seen == [4, 8, 8]


def test_json_batches(spark, tmp_path):
    at = sinks.write_json_batches(spark.range(250).coalesce(1), str(tmp_path))
    parts = [p for p in __import__("pathlib").Path(at).glob("*.json")]
    assert len(parts) == 3 and sum(len(p.read_text().splitlines()) for p in parts) == 250


def test_dead_letters_come_back_and_are_deleted(spark, tmp_path):
    bad = "f" * 256 + ".json"
    letters = spark.createDataFrame([("old.json", "kept text", "h0", 0, "too long before"), (bad, "again too long", "h1", 0, "x")], "file_name string, raw_content string, content_hash string, chunk_index int, error string").withColumn("information_weight", F.lit(0.5))
    sinks.write_dead_letters(letters, str(tmp_path / "dead"))
    write(tmp_path, "a.json", "one")
    run(spark, PipelineConfig(str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "dead"), resume=False), judge())
    table = sinks.ChunkTable(spark, str(tmp_path / "table"))
    assert table.read().where("file_name = 'old.json'").count() == 0
    before = sinks.dead_letters(spark, str(tmp_path / "dead"))
    run(spark, config(tmp_path), judge())
    assert [r.raw_content for r in table.read().where("file_name = 'old.json'").collect()] == ["kept text"]
    after = sinks.dead_letters(spark, str(tmp_path / "dead"))
    assert not set(before) & set(after)
    assert [r.file_name for r in spark.read.parquet(*after).collect()] == [bad]


def test_repeated_comments_have_ids_of_their_own(spark):
    doc = json.dumps({"comments_v2": [{"timestamp": 1, "title": "same", "data": [{"comment": {"comment": "same", "author": "Ann"}}]}] * 3})
    files = spark.createDataFrame([("facebook_data/comments.json", doc)], "path string, text string").select("path", F.parse_json("text").alias("doc"))
    out = exports.meta_comments(files).collect()
    assert len(out) == 3 and len({r.comment_id for r in out}) == 3


def test_attachments_of_messages(spark):
    part = {"media": {"uri": "a.MP4?x"}, "external_context": {"url": "http://x"}}
    doc = json.dumps({"participants": [{"name": "Ann"}], "messages": [{"sender_name": "Ann", "timestamp_ms": 1, "attachments": [{"data": [part]}, {"data": [{"audio_file": {"uri": "v.ogg"}}]}]}, {"sender_name": "Ann", "timestamp_ms": 2, "attachments": [{"data": [part]}]}]})
    files = spark.createDataFrame([("instagram_data/inbox/m.json", doc)], "path string, text string").select("path", F.parse_json("text").alias("doc"))
    out = sorted(exports.meta_messages(files).collect(), key=lambda r: r.pos)
    assert [(r.content_type, r.media_attachments) for r in out] == [("video", ["a.MP4?x"]), ("voice", ["a.MP4?x", "v.ogg"])]
