from quillspark.llm.mojibake import CHAINS, garble, garbled_tokens, p4_found, p4_restored, undo
from pyspark.sql import functions as F

CLEAN = ["Für", "Brücke", "Päckchen", "naïve", "我們聊到風箏", "外面一直下雨", "SÃO", "ÂME", "Łódź", "we’ll", "time…", "😀", "❤️", "Ça"]


def test_every_chain_can_be_undone():
    for chain in CHAINS:
        for word in ("Brücke", "我們", "’"):
            g = garble(word, chain)
            if g and "�" not in g and chain[0] != "big5":
                assert undo(g, chain) in (word, None), (chain, word, g)


def tables(spark, tmp_path):
    bad = [garble("Brücke", ("utf-8", "latin-1", 1)), garble("我們聊到風箏", ("utf-8", "gbk", 1)), garble("外面一直下雨", ("big5", "latin-1", 1)), garble("Päckchen", ("cp437", "cp1252", 1)), "na�ve"]
    clean = [(i, c) for i, c in enumerate(CLEAN * 6)]
    rows = clean + [(1000 + i, f"x {b} y") for i, b in enumerate(bad * 2)] + [(2000, None), (2001, ""), (2002, "  "), (2003, "plain " * 50_000)]
    for t, k in (("message_data", "msg_no"), ("chat_messages", "chat_no"), ("meta_posts", "post_no")):
        df = spark.createDataFrame(rows, f"{k} long, page_content string").withColumn("sender_name", F.lit("Jörg")).withColumn("token", F.lit("clash"))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


def test_found_and_restored(spark, tmp_path):
    d = tables(spark, tmp_path)
    got = {(r.tbl, r.row_id) for r in p4_found(spark, d).where("field_name = 'page_content'").collect()}
    assert got == {(t, i) for t in ("message_data", "chat_messages", "meta_posts") for i in range(1000, 1010)}
    back = {r.row_id: r.restored for r in p4_restored(spark, d).where("tbl = 'meta_posts'").collect()}
    assert back[1000] == "x Brücke y" and back[1002] == "x 外面一直下雨 y" and back[1003] == "x Päckchen y"


def test_garbled_forms_of_letters_only(spark):
    chains = {"SÃO": [("cp850", "cp1252", 1), ("mac-roman", "cp1252", 1)], "João": [("cp850", "cp1252", 1)], "für": [("mac-roman", "cp1252", 1), ("utf-8", "cp1250", 1)], "Straße": [("cp437", "cp1252", 1), ("utf-8", "cp1250", 1)], "café": [("cp1252", "mac-roman", 1), ("cp1252", "cp850", 1)]}
    bad = {garble(w, c): w for w, cs in chains.items() for c in cs}
    bad |= {"/".join(["x", garble("SÃO", ("cp850", "cp1252", 1))]): "x/SÃO", garble("Fürstentum", ("utf-8", "cp1250", 1)): "Fürstentum"}
    rows = [(w,) for w in [*chains, "voilà", "time…", "Château", "l’été", "Ängste", "Crème"] for _ in range(30)] + [("Túnel",), ("Ère",)] + [(b,) for b in bad]
    assert {r.token: r.original for r in garbled_tokens(spark.createDataFrame(rows, "token string")).collect()} == bad


def test_no_join_with_what_python_made_is_a_broadcast(spark):
    """What comes out of Python is larger than the planner thinks."""
    plan = garbled_tokens(spark.createDataFrame([("Brücke",)] * 30, "token string"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoop" not in plan


def test_chains_of_each_kind_between_clean_words(spark):
    clean = ["Für", "Brücke", "Straße", "naïve", "Mädchen"]
    bad = {"FĂĽr": "Für", "BrĂĽcke": "Brücke", "StraĂźe": "Straße", "naĂŻve": "naïve", "BrŸcke": "Brücke", "Straáe": "Straße", "Mõdchen": "Mädchen", "naÔve": "naïve", "laugh.ðŸ˜€": "laugh.😀"}
    df = spark.createDataFrame([(w,) for w in [*clean, "laugh.😀", "“Brücke”"] for _ in range(30)] + [(b,) for b in bad], "token string")
    assert {r.token: r.original for r in garbled_tokens(df).collect()} == bad


def test_long_chinese_token_of_a_two_byte_pair(spark):
    chain = ("big5", "gbk", 1)
    bad = garble("這是國家統計機關", chain)
    assert len(bad) == 8 and "�" not in bad
    df = spark.createDataFrame([("國家統計機關",)] * 30 + [("外面一直下雨",)] * 30 + [(bad,)], "token string")
    assert [tuple(r) for r in garbled_tokens(df).collect()] == [(bad, "這是國家統計機關")]


def test_empty(spark):
    assert garbled_tokens(spark.createDataFrame([], "token string")).count() == 0
