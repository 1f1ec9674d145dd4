from quillspark.llm.leakage import Document, Items, Part, _long_enough, find_leaks, template, tokens, windows

A = "The Cyrovia charter, 72 pages long, forbids any hypothesis from Lindark that diffused into 96 of the ordinary orbit kinds."
B = "The Voranna charter, 72 pages long, forbids any telescope from Pererby that absorbed 48 of the local plankton sample kinds."
C = "Observers counted 348 examples of the setlist at Cyrester, yet the inspector from Ruvomer trusted none but the ordinary clarinet."
Z = "據Ambolm檔案第176號記載，催化劑每隔2天汙染了Perithe的催化劑，從未超過12次。"
Q = "What followed from this?"


def leaks(spark, texts, **kw):
    items = spark.createDataFrame([(1, f"{A} {Q}"), (2, f"{B} {Q}"), (3, Z), (4, C), (5, None), (6, ""), (7, " ")], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in find_leaks(docs, items, **kw).collect()}


def test_passages_and_what_is_none(spark):
    texts = [
        f"Before. {A} After.",
        A.upper().replace(",", " ;"),
        "> " + A.replace(" forbids", "\n> forbids").replace("diffused", "seeped"),
        A.replace("Cyrovia", "Ruvanna").replace("72", "13").replace("Lindark", "Oskolm").replace("96", "4").replace("hypothesis", "ferry"),  # other parameters
        " ".join(A.split()[:11]),  # too short
        Q + " " + Q,
        "文章。" + Z.replace("，", "、") + "完。",
        Z[:14],
        None, "", "  ", f"{B} {A}", f"{B} {A}",
        A.replace("e", "е").replace("o", "ο"),  # letters of other scripts that look the same
        A.replace("pages", "old pages").replace("the ordinary", "ordinary"),  # a word more and a word less
        "文章。" + Z.replace("Perithe", "Per該the"),  # a foreign character inside a name
        A + " " + "the other words " * 3000,
    ]
    assert leaks(spark, texts) == {(0, 1), (1, 1), (2, 1), (6, 3), (11, 1), (11, 2), (12, 1), (12, 2), (13, 1), (14, 1), (15, 3), (16, 1)}


def test_other_values_in_the_slots_make_another_instance(spark):
    other = "examples of the setlist at Dovuna, yet the inspector from Lindalda trusted none but the ordinary clarinet and more of it"
    words = "examples of the setlist at such, yet the inspector from Ruvomer trusted none but the ordinary clarinet"
    new_names = "examples of the setlist at Unheardof, yet the inspector from Newtown trusted none but the ordinary clarinet"
    assert leaks(spark, [other, words, new_names, A.replace("72", "9"), A.replace("72 ", "9 ").replace("96", "7")]) == {(1, 4), (3, 1)}


def test_blocks_of_items_give_the_same(spark):
    texts = [A, f"x {B}", A.replace("72", "9"), "nothing here at all to be found in these words", Z]
    assert leaks(spark, texts, block_words=20) == leaks(spark, texts) == {(0, 1), (1, 2), (2, 1), (4, 3)}


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, A)], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(docs, items).collect() == []
    assert find_leaks(docs.limit(0), spark.createDataFrame([(1, A)], "item_id long, text string")).collect() == []


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, A, 5, "x")], "doc_id long, text string, item_id long, h string")
    items = spark.createDataFrame([(1, A, "y")], "item_id long, text string, doc_id string")
    assert [tuple(r) for r in find_leaks(docs, items).collect()] == [(1, 1)]


def test_one_in_eight_may_differ():
    held = Items([(1, 0, tokens(A), False)])
    part = held.parts[1, 0]
    ids = {w: k for k, w in enumerate(held.known)}
    n = len(part)
    free = [i for i, f in enumerate(template(part, held.names)) if f[0] != "<"]
    for wrong in range(6):
        doc = list(part)
        for k in free[1 : 3 * wrong : 3]:
            doc[k] = "other"
        places = [(a, a) for a in range(n - 4) if doc[a : a + 5] == part[a : a + 5]]
        want = any(sum(doc[i] != part[i] for i in range(a, b)) * 8 <= b - a for a in range(n) for b in range(a + 15, n + 1))
        assert Document(" ".join(doc), held.names, ids).holds(Part(part, held.names, ids), places) == (want and bool(places))


def test_stretches_over_two_diagonals():
    same = [0] * 8
    assert _long_enough({0: same + [1] * 8, 1: [1] * 8 + same}, 15)  # one word more
    assert not _long_enough({0: [0] * 8 + [1] * 6, 1: [1] * 8 + [0] * 6}, 15)
    assert not _long_enough({0: [0, 0, 1] * 6}, 15)


def test_windows_hold_the_values_of_their_slots():
    held = Items([(1, 0, tokens(A), False)])
    low = [w.lower() for w in tokens(A)]
    other = [w.replace("72", "73") for w in low]
    a, b = (windows(x, template(x, held.names)) for x in (low, other))
    assert [x[1] for x in a] == [x[1] for x in b] and a[0][2] != b[0][2]
