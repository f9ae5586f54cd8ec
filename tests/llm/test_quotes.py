"""Quotation linking."""

from lexigrain.llm import quotes

SCHEMA = "thread long, position long, root string, text string"


def _run(spark, rows, f=quotes.conversations):
    return f(spark.createDataFrame(rows, SCHEMA)).collect()


def test_nested_quotes_find_their_messages(spark):
    rows = [
        (1, 0, "a", "Hello there. How are you?\nFine I hope!"),
        (1, 1, "b", "> Hello there. How\n> are you?\n\nI am well."),
        (1, 2, "c", "On Monday a wrote:\n> FINE  I hope!\nMe too."),
        (1, 3, "d", ">> hello there. how are you?\n> I am well.\nGood to know"),
        (1, 4, "e", "No quote."),
        (1, 5, "f", "> Never said.\nOh."),
    ]
    out = {r["position"]: r for r in _run(spark, rows)}
    assert [out[i]["reply_to"] for i in range(6)] == [None, 0, 0, 1, 3, 4]
    assert [out[i]["text"] for i in range(1, 4)] == ["I am well.", "Me too.", "Good to know"]
    assert [out[i]["depth"] for i in range(6)] == [0, 1, 1, 2, 3, 4] and [out[i]["ord"] for i in range(6)] == [1, 2, 3, 4, 5, 6]
    links = {(r["position"], r["passage"]): (r["level"], r["parts"], r["linked_parts"], r["original"]) for r in _run(spark, rows, quotes.link_quotes)}
    assert links == {(1, 0): (1, 2, 2, 0), (2, 0): (1, 1, 1, 0), (3, 0): (2, 2, 2, 0), (3, 1): (1, 1, 1, 1), (5, 0): (1, 1, 0, None)}


def test_every_message_follows_the_one_it_answers_in_a_long_thread(spark):
    rows = [(1, i, "x", f"> Message number {i - 7}.\nMessage number {i}." if i % 3 == 0 and i > 7 else f"Message number {i}.") for i in range(0, 700)]
    out = {r["position"]: r for r in _run(spark, rows)}
    depth = {}
    for i in range(700):
        up = i - 7 if i % 3 == 0 and i > 7 else i - 1 if i else None
        assert out[i]["reply_to"] == up
        depth[i] = 0 if up is None else depth[up] + 1
        assert out[i]["depth"] == depth[i]
    order = sorted(range(700), key=lambda i: (depth[i], i))
    assert [out[i]["ord"] for i in order] == list(range(1, 701))


def test_odd_rows(spark):
    rows = [(2, 0, "x", None), (2, 0, "y", ""), (None, 1, "z", "> q\nz"), (2, None, "w", "w"), (3, 5, "v", ">"), (3, 5, "v", ">")]
    out = _run(spark, rows)
    assert len(out) == 6 and {r["reply_to"] for r in out} == {None} and {r["depth"] for r in out} == {0}
    assert sorted(str(r["text"]) for r in out) == ["", "", "", "None", "w", "z"]
    assert _run(spark, [], quotes.conversations) == [] and _run(spark, [], quotes.link_quotes) == []


def test_the_latest_mark_before_any_position(spark):
    marks = [0, 3, 255, 256, 1000, 70000]
    asks = [0, 1, 3, 4, 255, 256, 257, 600, 1000, 1001, 69999, 70000, 90000]
    m = spark.createDataFrame([(1, p) for p in marks], "g long, p long")
    a = spark.createDataFrame([(1, p) for p in asks] + [(2, 5)], "g long, p long")
    out = {(r["g"], r["p"]): r["before"] for r in quotes.latest_before(a, m, ["g"], "p", "before").collect()}
    assert out == {(1, p): max((x for x in marks if x < p), default=None) for p in asks} | {(2, 5): None}
