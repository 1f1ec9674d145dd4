"""Column functions on texts, paths and identifiers. All are built-in expressions; null stays null unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's str.strip() takes off.
BLANKS = "\\u0009-\\u000d\\u001c-\\u0020\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Prefixes of replies and forwards.
SUBJECT_PREFIX = rf"\A(?:(?i:re|fwd|fw|回覆|轉寄)[{BLANKS}]*[:：][{BLANKS}]*)+"
#: Words in a path that give a document's type, in the order of the tests.
DOC_TYPES = [
    ("academic_paper", ["學術", "論文", "paper", "academic", "research", "thesis", "dissertation"]),
    ("journal_diary", ["日記", "日誌", "diary", "journal"]),
    ("business_report", ["出差", "報告", "business", "report", "meeting", "會議"]),
    ("creative_writing", ["寫作", "小說", "creative", "writing", "novel", "story", "故事"]),
]
#: Lines that open a quoted message, and signatures of devices.
QUOTE_OPENERS = r"\A(?:(?i:On\s+.+?wrote:\z)|(?i:-{3,}\s*Original Message\s*-{3,})|_{3,}\z|(?i:From:\s+.*<.+@.+>))"
DEVICE_LINES = r"\A(?i:Sent from my (?:iPhone|iPad|Android)|從我的\s*(?:iPhone|iPad|Android)\s*傳送)"
#: Texts that stand for media, by type, in the order of the tests.
MEDIA_TEXTS = [("image", ["[相片]", "[圖片]", "[貼圖]", "傳送了貼圖", "image omitted"]), ("voice", ["[語音訊息]", "[語音]", "audio omitted"]), ("video", ["[影片]", "video omitted"])]
#: Senders of advertisements.
SPAM_SENDER, SPAM_PART = "LINE購物", "Line 銀行"


def pystrip(c: Column) -> Column:
    """Without the blanks, of any kind, at both ends."""
    return F.regexp_replace(c, rf"\A[{BLANKS}]+|[{BLANKS}]+\z", "")


def clean_text(c: Column) -> Column:
    """Runs of newlines to one, runs of blanks and tabs to one blank, ends cut."""
    return pystrip(F.regexp_replace(F.regexp_replace(c, r"\n+", "\n"), r"[ \t]+", " "))


def clean_subject(c: Column) -> Column:
    """The subject without stacked prefixes; null or nothing left: ``No Subject``."""
    bare = pystrip(F.regexp_replace(pystrip(c), SUBJECT_PREFIX, ""))
    return F.when(c.isNull() | (bare == ""), "No Subject").otherwise(bare)


def clean_body(c: Column) -> Column:
    """The lines before the first quoted message, without lines that start with ``>`` and device signatures."""
    lines = F.transform(F.split(c, "\n"), pystrip)
    at = F.array_position(F.transform(lines, lambda s: s.rlike(QUOTE_OPENERS)), True)
    own = F.when(at > 0, F.slice(lines, 1, (at - 1).cast("int"))).otherwise(lines)
    kept = F.filter(own, lambda s: ~s.startswith(">") & ~s.rlike(DEVICE_LINES))
    return F.regexp_replace(pystrip(F.array_join(kept, "\n")), r"\n{3,}", "\n\n")


def fix_latin1(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, read rightly; unchanged where that is impossible; null gives ''."""
    fits = ~c.rlike(r"[^\x{00}-\x{ff}]")
    data = F.encode(F.when(fits, c), "ISO-8859-1")
    return F.coalesce(F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")), c, F.lit(""))


def doc_type(path: Column) -> Column:
    low = F.lower(path)
    out = F.lit(None).cast("string")
    for kind, words in reversed(DOC_TYPES):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, kind).otherwise(F.coalesce(out, F.lit("general")))
    return out


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Lower-case extension without its dot; '' without one."""
    return F.lower(F.regexp_extract(basename(path), r".\.([^.]*)\z", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*\z", "")


def meta_source(path: Column) -> Column:
    parts = F.split(path, "/")
    out = F.lit("unknown")
    for kind in ("threads", "instagram", "facebook"):
        out = F.when(F.array_contains(parts, f"{kind}_data"), kind).otherwise(out)
    return out


def meta_route(path: Column) -> Column:
    """messages, comments, posts or null, by the file's name and folders; the first match counts."""
    name = F.lower(basename(path))
    has = lambda w: F.contains(name, F.lit(w))
    return F.when(has("message") | F.array_contains(F.split(path, "/"), "inbox"), "messages").when(has("comment"), "comments").when(has("post") | has("profile"), "posts")


def chat_source(*places: Column) -> Column:
    """line, whatsapp or unknown, by title, folder and file name together."""
    low = F.lower(F.concat_ws(" ", *places))
    return F.when(F.contains(low, F.lit("line")), "line").when(F.contains(low, F.lit("whatsapp")), "whatsapp").otherwise("unknown")


def sniff_type(content_type: Column, text: Column) -> Column:
    """The type that a text such as ``[相片]`` names; only of texts and links."""
    low = F.lower(pystrip(F.regexp_replace(text, r"[​-‏‪-‮﻿]+", "")))
    out = content_type
    for kind, words in reversed(MEDIA_TEXTS):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, kind).otherwise(out)
    return F.when(content_type.isin("text", "link"), out).otherwise(content_type)


def keep_chat(content_type: Column, text: Column) -> Column:
    """Whether a chat message is kept: no medium alone, not blank, no markup."""
    t = F.coalesce(text, F.lit(""))
    return ~F.coalesce(content_type, F.lit("")).isin("image", "video", "voice") & (pystrip(t) != "") & ~F.contains(F.lower(t), F.lit("html"))


def not_spam(sender: Column, line: bool = True) -> Column:
    s = F.coalesce(sender, F.lit(""))
    return ~F.contains(s, F.lit(SPAM_PART)) & ((s != SPAM_SENDER) if line else F.lit(True))


def message_key(header: Column, subject: Column, time: Column) -> Column:
    """The Message-ID without angle brackets, or one made of subject and time."""
    own = F.concat(F.lit("msg_"), F.md5(F.concat(F.coalesce(subject, F.lit("")), F.coalesce(time, F.lit("")))))
    return F.regexp_replace(F.coalesce(header, own), r"\A[<>]+|[<>]+\z", "")


def uuid5(name: Column, namespace: str = "6ba7b8109dad11d180b400c04fd430c8") -> Column:
    """Version 5 UUID of a name; the namespace is that of host names."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))
