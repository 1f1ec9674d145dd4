from quillspark.llm import pii
from quillspark.llm.pii import Parser, name_forms, p5_found, p5_masked, possible_names, tax_digits

P = Parser({"Kester", "Rose", *name_forms("Günther")}, {"Ashford", "Selwell"}, set("芷怡柏睿"))
CASES = [
    ("Mail a.b+c@x-y.example or d.e [at] postern [dot] test, f＠g.test", {("email", "a.b+c@x-y.example"), ("email", "d.e [at] postern [dot] test"), ("email", "f＠g.test")}),
    ("Ring 0491 570 731, +44 7700 900509, (212) 555-0143, 617.555.0112 or ０９００－０１１－７８６.", {("phone", x) for x in ("0491 570 731", "+44 7700 900509", "(212) 555-0143", "617.555.0112", "０９００－０１１－７８６")}),
    ("Order 83460468, ticket 55-347-93, build 10.8.0.2, on 2021-03-18 04:23 and 18/02/2025.", set()),
    ("The passport number QQ 85 52 80 C, 973-73-2204, X42136454 and C7X85870F9", {("id_no", x) for x in ("QQ 85 52 80 C", "973-73-2204", "X42136454", "C7X85870F9")}),
    ("庭庭的統編是28645051，地址北澄市楓林大道3段168號5樓。", {("id_no", "28645051"), ("address", "北澄市楓林大道3段168號5樓")}),
    ("Kester Ashford's flat is at Flat 23, 11 Alder Quay, Stennick 95841, second bell.", {("person", "Kester Ashford"), ("address", "Flat 23, 11 Alder Quay, Stennick 95841")}),
    ("Ms Selwell met P. Selwell and kester ashford in Alder Quay; kester.ashford@a.test", {("person", "Selwell"), ("person", "P. Selwell"), ("person", "kester ashford"), ("email", "kester.ashford@a.test")}),
    ("The rose by the gate is out again. Ping me @desk if anything breaks.", set()),
    ("林芷怡說星期五會到。柏睿：", {("person", "林芷怡"), ("person", "柏睿")}),
    ("Das Paket geht an Mühlenweg 78, 34436 Tannhagen. Mühlenweg ist lang.", {("address", "Mühlenweg 78, 34436 Tannhagen")}),
    ("GÃ¼nther Ashford met Rose-Kester; (Günther) and Kester’s GÃ¼nther, Selwell", {("person", x) for x in ("GÃ¼nther Ashford", "Rose", "Kester", "Günther", "GÃ¼nther", "Selwell")}),
    ("Social security 123456789, order 123456789, 123456789; Steuer 36574261809, 36574261808.", {("id_no", "123456789"), ("id_no", "36574261809")}),
    ("", set()),
]


def test_parsers():
    for text, want in CASES:
        assert P.find(text) == want, text


def rows(spark, tmp_path):
    texts = [f"{g} {s} <x@y.test> writes:\n{c}" for c, _ in CASES for g in ("Kester", "Rose", "Günther") for s in ("Ashford", "Selwell", "Wexby")] + ["王芷怡於2020-01-01寫道:", "李柏睿於2020-01-01寫道:"] * 5
    spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*texts, None, "", "x " * 100_000])], "msg_no long, page_content string, kind string").write.parquet(f"{tmp_path}/message_data.parquet")
    spark.createDataFrame([], "id long, raw_content string").write.parquet(f"{tmp_path}/writing_style_logs.parquet")
    return str(tmp_path)


def test_broadcast_and_joined_names_agree(spark, tmp_path, monkeypatch):
    d = rows(spark, tmp_path)
    a = {tuple(r) for r in p5_found(spark, d).collect()}
    assert ("message_data", 0, "person", "Kester Ashford") in a and any(r[2] == "address" for r in a)
    monkeypatch.setattr(pii, "BROADCAST_NAMES", 0)
    b = {tuple(r) for r in p5_found(spark, d).collect()}
    assert a == b
    masked = {r.row_id: r.masked for r in p5_masked(spark, d).collect()}
    assert masked[0].startswith("[PERSON] <[EMAIL]> writes:\nMail [EMAIL] or [EMAIL], [EMAIL]")


def test_digits_that_check_others():
    assert tax_digits("36574261809") and not tax_digits("36574261808") and not tax_digits("06574261809")


def test_possible_names_are_all_that_anchors_can_meet():
    got = possible_names("GÃ¼nther, Anna-Lena’s (x) 王芷怡", 12)
    assert {"gã¼nther", "anna", "lena", "anna-lena", "x"} <= got and "gã¼nth" not in got
