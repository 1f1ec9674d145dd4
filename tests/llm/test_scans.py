from quillspark.llm.scans import p3_found, p3_repaired, scan_noise

GOOD = ["The committee wondered about the window and", "the garden before the others came back in the", "evening. There was nothing more to be done."]


def chunk(k, i):
    lines = [*GOOD, "We talked about the garden and the win-", "dow for a very long time that evening. A well-", "known friend left before the others came."]
    if i == 0:
        lines[1] = lines[1].replace("garden", "gardcn")
    return "\n".join([*lines[:2], "NOTES ON THE GARDEN", f"- {10 + i} -", *lines[2:]])


def logs(spark):
    rows = [(k * 100 + i, f"scan{k}.pdf", i, chunk(k, i)) for k in range(4) for i in range(6)]
    rows += [(5000 + i, f"clean{i}.txt", 0, "The well-known committee wondered about the window and the garden.\nSummary\nReadings:\n12\n7\n30") for i in range(8)]
    rows += [(9000, None, None, None), (9001, "e.txt", 0, ""), (9002, None, 3, "x"), (9003, "long.txt", 0, "word " * 50_000)]
    return spark.createDataFrame(rows, "id long, file_name string, chunk_index int, raw_content string")


def test_kinds_of_noise(spark, tmp_path):
    logs(spark).write.parquet(f"{tmp_path}/writing_style_logs.parquet")
    got = {tuple(r) for r in p3_found(spark, str(tmp_path)).collect()}
    ids = [k * 100 + i for k in range(4) for i in range(6)]
    assert {(i, n) for i, n, k in got if k == "header"} == {(i, 2) for i in ids}
    assert {(i, n) for i, n, k in got if k == "page_no"} == {(i, 3) for i in ids}
    assert {(i, n) for i, n, k in got if k == "hyphen"} == {(i, 5) for i in ids}  # well-known has its own hyphen
    assert {(i, n) for i, n, k in got if k == "glyph"} == {(k * 100 + i, 1) for k in range(4) for i in (0,)}
    back = {r.id: r.repaired for r in p3_repaired(spark, str(tmp_path)).collect()}
    assert "gardcn" not in back[0] and "the window for a very long" in back[0] and "NOTES" not in back[0] and "- 10 -" not in back[0]


def test_headers_that_alternate(spark, tmp_path):
    heads = ["NOTES ON THE GARDEN", "The Final Window"]
    beside = [(i, "beside.txt", i, "\n".join([*GOOD[:2], heads[i % 2], f"[{60 + i}]", GOOD[2]])) for i in range(6)]
    edge = [(100 + i, "edge.pdf", i, "\n".join([*GOOD[:2], f"{70 + i}   {heads[0]}" if i % 2 else f"{heads[1]}   {70 + i}", GOOD[2]])) for i in range(6)]
    # A line of running text that returns in the file and once meets a page number is no header.
    text = [(200 + i, "text.txt", i, "\n".join([*GOOD[:2], "Please send the parcel to", f"[{60 + i}]" if i == 1 else GOOD[1], GOOD[2], heads[0], f"[{80 + i}]", GOOD[1]])) for i in range(6)]
    spark.createDataFrame(beside + edge + text, "id long, file_name string, chunk_index int, raw_content string").write.parquet(f"{tmp_path}/writing_style_logs.parquet")
    got = {(r.id, r.line_no) for r in p3_found(spark, str(tmp_path)).where("kind = 'header'").collect()}
    assert got == {(k + i, 2) for k in (0, 100) for i in range(6)} | {(200 + i, 5) for i in range(6)}
    back = {r.id: r.repaired for r in p3_repaired(spark, str(tmp_path)).where("id < 200").collect()}
    assert len(back) == 12 and not any("GARDEN" in t or "Final Window" in t for t in back.values())


def test_words_over_a_chunks_end_and_words_in_words(spark, tmp_path):
    rows = []
    for k in range(8):
        ends = "We talked about the garden and the win-" if k == 0 else "We talked about the garden."
        rows += [(k * 10, f"s{k}.pdf", 0, "\n".join([*GOOD, f"- {10 + k} -", ends])), (k * 10 + 1, f"s{k}.pdf", 1, "\n".join(["dow stood open there all night" if k == 0 else "The window stood open", *GOOD]))]
    rows += [(900 + i, "s0.pdf", 0, rows[0][3]) for i in range(2)] + [(910, "s0.pdf", 1, rows[1][3])]  # the same chunks again
    rows += [(1000 + i, "clean.txt", i, "the tin rim was near the others and the tin rim was there") for i in range(60)]
    rows += [(2000, "s1.pdf", 2, "the tiu rim was near the tiui of others\n- 12 -")]
    spark.createDataFrame(rows, "id long, file_name string, chunk_index int, raw_content string").write.parquet(f"{tmp_path}/writing_style_logs.parquet")
    back = {r.id: r.repaired for r in p3_repaired(spark, str(tmp_path)).collect()}
    for i in (0, 900, 901):
        assert back[i].endswith("and the window")
    for i in (1, 910):
        assert back[i].startswith("stood open there all night")
    assert back[11].startswith("The window stood open")
    assert "tiui" in back[2000]


def test_empty(spark):
    assert all(x.count() == 0 for x in scan_noise(logs(spark).limit(0)))
