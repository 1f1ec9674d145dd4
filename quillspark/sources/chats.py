"""Chats exported as HTML: the markup gives events, Spark does the rest (state carried forward, filters, types)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.threads import carried_forward

#: Tags of layout, and ends of media files.
LAYOUT = {"nav", "aside", "header", "footer", "script", "style"}
VOID = {"br", "img", "hr", "input", "meta", "link", "source", "area", "base", "col", "embed", "wbr"}
VIDEO, VOICE = (".mp4", ".mov", ".avi", ".mkv", ".webm"), (".mp3", ".m4a", ".wav", ".ogg", ".aac")
EVENTS = "file string, title string, pos long, kind string, sender string, time string, body string, media_type string, media array<string>"


class Node:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        for k in self.kids:
            if isinstance(k, Node):
                yield k
                yield from k.walk()

    def strings(self) -> Iterator[str]:
        for k in self.kids:
            if isinstance(k, str):
                yield k
            else:
                yield from k.strings()

    def text(self) -> str:
        return " ".join(x for x in (s.strip() for s in self.strings()) if x)

    def classed(self, pattern: str) -> bool:
        return bool(re.search(pattern, self.attrs.get("class", ""), re.I))


class Tree(HTMLParser):
    """A tree of the markup without its layout tags; unclosed tags end with their parent."""

    def __init__(self, markup: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("root", {}, None)
        self.feed(markup)
        self.close()
        for n in list(self.root.walk()):
            if n.tag in LAYOUT and n.parent:
                n.parent.kids = [k for k in n.parent.kids if k is not n]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(n)
        if tag not in VOID:
            self.at = n

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n.parent and n.tag != tag:
            n = n.parent
        if n.parent:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def media_of(n: Node) -> tuple[str, list[str]]:
    """Type and addresses of the media in an element; of several kinds the later one gives the type."""
    kind, out = "text", []
    nodes = list(n.walk())
    for tag, name in (("img", "image"), ("video", "video"), ("audio", "voice")):
        for x in nodes:
            if x.tag == tag:
                kind = name
                src = x.attrs.get("src") or next((y.attrs.get("src", "") for y in x.walk() if y.tag == "source"), "")
                if src:
                    out.append(src)
    for x in nodes:
        href = x.attrs.get("href", "") if x.tag == "a" else ""
        if href and not href.startswith("#"):
            low = href.lower().split("?")[0]
            if low.endswith(VIDEO):
                kind = "video"
            elif low.endswith(VOICE):
                kind = "voice"
            elif not out:
                kind = "link"
            out.append(href)
    return kind, out


def _first(n: Node, pattern: str) -> Node | None:
    return next((x for x in n.walk() if x.classed(pattern)), None)


def events_of(markup: str, source: str) -> tuple[str, list[tuple]]:
    """(title, events) of one page; an event is (kind, sender, time, body, media type, media)."""
    root = Tree(markup).root
    title = next((x.text() for x in root.walk() if x.tag == "title"), "")
    out: list[tuple] = []
    if source == "line":
        box = next((x for x in root.walk() if x.classed(r"(?:^|\s)content(?:\s|$)") or x.attrs.get("id") == "container"), root)
        for x in (k for k in box.kids if isinstance(k, Node)):
            t = x.text()
            if x.tag == "p" and x.attrs.get("align") == "center" and re.search(r"\d{4}/\d{2}/\d{2}", t):
                out.append(("state", None, t.strip(), None, None, []))
            elif x.tag == "p" and x.attrs.get("align") == "left" and not x.attrs.get("class"):
                if t and not t.startswith(("Account:", "TO:")):
                    out.append(("state", t, None, None, None, []))
                elif t.startswith("TO:"):
                    out.append(("to", None, None, t[3:].strip(), None, []))
            elif x.tag in ("p", "table") and x.classed("triangle"):
                out.append(("message", None, None, t, *media_of(x)))
        return title, out
    who = "name|sender|author" if source == "whatsapp" else "name|sender|author|user"
    blocks = [x for x in root.walk() if x.classed("message|msg" if source == "whatsapp" else "message|msg|chat|bubble")]
    if not blocks and source != "whatsapp":
        blocks = [x for x in root.walk() if x.tag in ("div", "p", "li")]
    for x in blocks:
        sender, time, body = _first(x, who), _first(x, "time|date|timestamp"), _first(x, "text|content|body")
        s, t = sender.text() if sender else "Unknown", time.text() if time else ""
        got = (body or x).text()
        if body is None:
            got = got.removeprefix(s).removesuffix(t).strip() if t else got.removeprefix(s).strip()
        out.append(("message", s, t, got, *media_of(body or x)))
    return title, out


def chat_events(pages: DataFrame) -> DataFrame:
    """Events of pages (file, markup), in their order."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for file, markup in zip(pdf["file"], pdf["markup"], strict=True):
                head = re.search(r"<title[^>]*>(.*?)</title>", markup or "", re.I | re.S)
                low = f"{head[1] if head else ''} {file}".lower()
                source = "line" if "line" in low else "whatsapp" if "whatsapp" in low else "unknown"
                title, events = events_of(markup or "", source)
                rows += [(file, title, i, *e) for i, e in enumerate(events)]
            yield pd.DataFrame(rows, columns=["file", "title", "pos", "kind", "sender", "time", "body", "media_type", "media"])

    return pages.select("file", "markup").mapInPandas(run, EVENTS)


def chat_messages(pages: DataFrame) -> DataFrame:
    """file, source, thread_id, pos, sender_name, timestamp, page_content, content_type, media_attachments."""
    x = chat_events(pages)
    bucket = F.floor(F.col("pos") / 4096)
    x = carried_forward(x, ["file"], bucket, "pos", "sender", "Unknown", "sender_name")
    x = carried_forward(x, ["file"], bucket, "pos", "time", "", "timestamp")
    source = text.chat_source(F.col("title"), F.col("file"))
    to = x.where("kind = 'to'").groupBy("file").agg(F.min_by("body", "pos").alias("to"))
    x = x.join(to, "file", "left").withColumn("source", source).where("kind = 'message'")
    name = F.when((F.col("source") == "whatsapp") & (F.lower("title") != "whatsapp messages") & (F.col("title") != ""), F.col("title")).when((F.col("source") == "line") & (F.col("to") != ""), F.col("to")).otherwise(text.stem(F.col("file")))
    x = x.withColumn("thread_id", name).withColumn("content_type", text.sniff_type(F.col("media_type"), F.col("body")))
    x = x.where(text.keep_chat(F.col("content_type"), F.col("body")) & text.not_spam(F.col("sender_name"), False) & ((F.col("source") != "line") | text.not_spam(F.col("sender_name"))))
    return x.select("file", "source", "thread_id", "pos", "sender_name", "timestamp", F.col("body").alias("page_content"), "content_type", F.col("media").alias("media_attachments"))


def read_chats(spark: SparkSession, folder: str) -> DataFrame:
    """All .html files below a folder, in any case of the extension."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(F.lower("path").endswith(".html"))
    return chat_messages(x.select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("markup")))


def _escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(F.coalesce(c, F.lit("")), F.lit(a), F.lit(b))
    return c


def line_markup_of(sender: Column, time: Column, content: Column) -> Column:
    """One message as a LINE page: a date and a sender, each if there is one, the message, and a line that is none."""
    p = lambda c, attrs: F.when(text.pystrip(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(f"<p {attrs}>"), _escaped(c), F.lit("</p>"))).otherwise("")
    return F.concat(F.lit('<html><title>x</title><div class="content">'), p(time, 'align="center"'), p(sender, 'align="left"'), F.lit('<p class="note">no message</p><table class="triangle-isosceles left"><tr><td>'), _escaped(content), F.lit("</td></tr></table></div></html>"))


def markup_of(sender: Column, time: Column, content: Column) -> Column:
    """One message as such a page's block, for tests and for queries over given tables."""
    esc = _escaped
    return F.concat(F.lit('<html><title>WhatsApp Messages</title><div class="message"><span class="sender">'), esc(sender), F.lit('</span><span class="time">'), esc(time), F.lit('</span><div class="text">'), esc(content), F.lit("</div></div></html>"))
