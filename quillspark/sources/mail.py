"""Mailboxes: a Python data source with one partition for each mbox file, and the parsing of messages."""

from __future__ import annotations

import email
import glob
import os
import re
from collections.abc import Iterator
from email.header import decode_header
from email.utils import parseaddr
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import dates, text

PARSED = "struct<subject:string,date:string,sender:string,receiver:string,message_id:string,body:string>"


class _Text(HTMLParser):
    """The text of markup, its pieces joined by newlines; scripts and styles have none."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(data)


def html_text(markup: str) -> str:
    p = _Text()
    p.feed(markup)
    p.close()
    return "\n".join(p.out)


def header_text(raw: str | None) -> str:
    """A header's words, decoded; what can't be decoded stays as it stands."""
    if raw is None:
        return ""
    try:
        out = []
        for part, charset in decode_header(str(raw)):
            if isinstance(part, bytes):
                try:
                    out.append(part.decode(charset or "utf-8", "replace"))
                except LookupError:
                    out.append(part.decode("utf-8", "replace"))
            else:
                out.append(part)
        return "".join(out).strip()
    except Exception:  # noqa: BLE001
        return str(raw).strip()


def body_text(message: email.message.Message) -> str:
    """All plain parts, or else the text of all HTML parts; attachments of other types have none."""
    plain, markup = [], []
    for part in message.walk():
        kind = part.get_content_type()
        if part.is_multipart() or kind not in ("text/plain", "text/html"):
            continue
        data = part.get_payload(decode=True) or b""
        try:
            got = data.decode(part.get_content_charset() or "utf-8", "replace")
        except LookupError:
            got = data.decode("utf-8", "replace")
        (plain if kind == "text/plain" else markup).append(got)
    whole = "".join(plain)
    return html_text(whole if whole.strip() else "".join(markup))


def parse_message(data: bytes) -> tuple:
    m = email.message_from_bytes(data)
    one = lambda name: parseaddr(header_text(m.get(name)))[1].lower()
    return header_text(m.get("Subject")), str(m.get("Date") or ""), one("From"), one("To"), m.get("Message-ID"), body_text(m)


def parsed(raw: Column) -> Column:
    """struct of a message's fields, from its bytes."""

    @F.pandas_udf(PARSED)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_message(bytes(b)) if b is not None else (None,) * 6 for b in s], columns=["subject", "date", "sender", "receiver", "message_id", "body"])

    return run(raw)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in sorted(glob.glob(os.path.join(self.folder, "*.mbox")))]

    def read(self, partition: _File) -> Iterator[tuple]:
        """Messages begin at a line ``From `` after a blank line or at the start; the file is read as a stream."""
        if partition is None or not getattr(partition, "path", None):
            return
        n, held, blank = 0, None, True
        with open(partition.path, "rb") as f:
            for line in f:
                if blank and line.startswith(b"From "):
                    if held is not None:
                        yield os.path.basename(partition.path), n, bytes(held)
                        n += 1
                    held = bytearray()
                elif held is not None:
                    held += line[1:] if re.match(rb">+From ", line) else line
                blank = line in (b"\n", b"\r\n")
        if held is not None:
            yield os.path.basename(partition.path), n, bytes(held)


class MboxSource(DataSource):
    """``spark.read.format("mbox").option("path", folder)``: file, msg_idx, raw."""

    @classmethod
    def name(cls) -> str:
        return "mbox"

    def schema(self) -> str:
        return "file string, msg_idx long, raw binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def message_rows(raw: DataFrame, my_email: str) -> DataFrame:
    """E-mails (file, msg_idx, raw) as cleaned messages; empty bodies are dropped."""
    x = raw.select("file", "msg_idx", parsed(F.col("raw")).alias("m"))
    x = x.select("file", "msg_idx", text.clean_subject(F.col("m.subject")).alias("subject"), dates.rfc2822_to_iso(F.col("m.date")).alias("timestamp"), F.col("m.sender").alias("sender"), F.col("m.receiver").alias("receiver"), F.col("m.message_id").alias("header_id"), text.clean_body(F.col("m.body")).alias("page_content"))
    x = x.where("page_content <> ''")
    return x.select("file", "msg_idx", text.message_key(F.col("header_id"), F.col("subject"), F.col("timestamp")).alias("message_id"), "subject", F.md5("subject").alias("thread_id"), "page_content", "sender", "receiver", "timestamp", (F.col("sender") == F.lit(my_email.lower())).alias("is_me"), F.col("file").alias("source_file"))
