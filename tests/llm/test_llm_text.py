"""Language, page text, line dedup and near copies."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lexigrain.llm import components, language, line_dedup, memory, near_copies, page_text

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def _segmentations(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        for rest in _segmentations(word[i:]):
            yield [word[:i], *rest]


def _random_chances(known):
    chances = np.random.default_rng(2).random((len(known) + 2, 2)) ** 8
    chances[-1] = 0
    return chances / chances.sum(axis=0)


def test_long_runs_are_summed_over_all_segmentations_as_well():
    known = language.pieces(VOCABULARY)
    number = {x: i for i, x in enumerate(known.names)}
    chances = _random_chances(known)
    for word in ["unbelievable" * 4 + "x", "日本語の文には空白がない" * 9, "donaudampfschifffahrt" * 400]:
        text = "▁" + word
        sums = [np.zeros(2)]  # logarithms
        for j in range(1, len(text) + 1):
            spans = [text[i:j] for i in range(max(0, j - known.longest), j)]
            ids = [number.get(p, len(known) if len(p) == 1 else -1) for p in spans]
            ways = [sums[j - len(p)] + np.log(chances[i]) for p, i in zip(spans, ids, strict=True) if i >= 0]
            sums.append(np.logaddexp.reduce(ways))
        assert language.word_scores(["a", word], known, chances)[1] == pytest.approx(sums[-1], rel=1e-9)


def test_long_runs_use_pieces_as_short_ones_do(monkeypatch):
    known = language.pieces(VOCABULARY)
    chances = _random_chances(known)
    words = ["the", "Übersetzung", "q", "日語", "incomprehensibilities" * 2]
    counts = np.arange(1.0, 11).reshape(5, 2)
    scores, used = language.word_scores(words, known, chances), language.expected_pieces(words, counts, known, chances)
    monkeypatch.setattr(language, "TOGETHER", 0)
    monkeypatch.setattr(language, "PLACES", 16)
    assert language.word_scores(words, known, chances) == pytest.approx(scores, rel=1e-9)
    assert language.expected_pieces(words, counts, known, chances) == pytest.approx(used, rel=1e-9, abs=1e-12)


def test_word_scores_sum_all_segmentations():
    known = language.pieces(VOCABULARY)
    number = {x: i for i, x in enumerate(known.names)}
    rng = np.random.default_rng(1)
    chances = rng.random((len(known) + 2, 2))
    chances[-1] = 0
    chances /= chances.sum(axis=0)
    words = ["the", "über", "q", "日語", "\U0001f600x"]
    for word, score in zip(words, language.word_scores(words, known, chances), strict=True):
        total = np.zeros(2)
        for cut in _segmentations("▁" + word):
            ids = [number.get(p, len(known) if len(p) == 1 else len(known) + 1) for p in cut]
            total += np.prod([chances[i] for i in ids], axis=0)
        assert np.exp(score) == pytest.approx(total, rel=1e-9)
    used = language.expected_pieces(["the"], np.ones((1, 2)), known, chances)
    by_hand, whole = np.zeros_like(used), np.zeros(2)
    for cut in _segmentations("▁the"):
        ids = [number.get(p, len(known) if len(p) == 1 else len(known) + 1) for p in cut]
        p = np.prod([chances[i] for i in ids], axis=0)
        whole += p
        for i in ids:
            by_hand[i] += p
    assert used == pytest.approx(by_hand / whole)


def test_language_is_learned_and_told(spark):
    rng = random.Random(5)
    stock = {"en": "the of and to house water small great".split(), "de": "der die und zu haus wasser klein groß".split(),
             "fr": "le la et du maison eau petit grande".split()}
    rows = [(i, " ".join(rng.choices(stock[x], k=30)), x, "z") for i, x in enumerate(list(stock) * 20)]
    df = spark.createDataFrame(rows, "key long, gloss string, language string, score string")
    model = language.train(df.where("key % 4 <> 2"), VOCABULARY)
    assert model.languages == ["de", "en", "fr"]
    odd = [(100, None, None, ""), (101, "", None, ""), (102, "12 -- ½", "en", ""), (None, "THE HOUSE and the water", None, ""), (103, "haus" * 60, None, "")]
    out = {r["key"]: (r["language"], r["score"]) for r in language.identify(df.unionByName(spark.createDataFrame(odd, df.schema)), model).collect()}
    assert all(out[k][0] == x for k, _, x, _ in rows)
    assert [out[k] for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert out[None][0] == "en" and out[103][0] == "de" and all(0 <= s <= 1 for _, s in out.values())
    none = language.train(df.where("false"), VOCABULARY)
    assert {r["language"] for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(df.where("false"), model).collect() == []


LONG = "This is a paragraph of the article, and it is long enough to be the main text of the page; " * 3


@pytest.mark.parametrize(("markup", "text"), [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain &amp; simple", "plain & simple"),
    (f"<nav><a href=x>Menu</a></nav><div class='ad'>Buy it and be happy with it.</div><article><h1>Title</h1><p>{LONG}<p>Short &lt;b&gt;\n x.</article><footer>&copy; me</footer>",
     "Title\n" + LONG.strip() + "\nShort <b> x."),
    (f"<body><header>The site</header><div id=main-text><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><form><p>{LONG}</p></form>"
     f"<div class='user-comments'><p>{LONG}</p></div><aside>{LONG}</aside></body>", "Head\n" + LONG.strip() + "\nShort.\n" + LONG.strip()),
    ("<article><p>One</p><script>var t='</p>';</script><p>Two <a href=x>link</a></p><p>x | y | z</p><article class=comment><p>Hm</p></article></article>",
     "One\nTwo link\nx | y | z"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>unclosed <b>bold<br>text<p>next &am", "T\nunclosed bold text\nnext &am"),
    (f"<div><ul><li><a href=a>One link to it</a><li><a href=b>And one more</a></ul><p>{LONG}</p></div>", LONG.strip()),
])
def test_page_text(markup, text):
    assert page_text.page_text(markup) == text


@pytest.mark.parametrize("wrapper", [
    "<div class='content with-sidebar'>", "<div class='no-comments'>", "<div id=has-banner>", "<form id=aspnetForm>", "<div class='layout-sidebar'>",
    "<div class='discussion-page'>", "<form><div class='widget menu-open'>", "<div class='cookie-consent-open'>",
])
@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_a_wrapper_does_not_decide_for_a_whole_page(wrapper, mark):
    talk = "discussion" in wrapper
    page = f"<body><h4>Site</h4>{wrapper}<ul class=menu><li>Home</ul><{mark}><p>{LONG}</p></{mark}><div class=comments><p>{LONG} Hm.</p></div></body>"
    text = page_text.page_text(page).removeprefix("Site\n")
    assert text == ("Site" if talk and mark == "div" else LONG.strip())


@pytest.mark.parametrize("beside", [
    "<div class=comments><article><p>{0}</p></article><article><p>{0}</p></article></div>", "<div class=sidebar><p>{0}</p><p>{0}</p></div>",
    "<div class=related><article><p>{1}</p></article><article><p>{1}</p></article></div>", "<form><p>{0}</p></form>", "<div class='ad box'><p>{0}{0}</p></div>",
    "<aside><article><p>{1}</p></article></aside>",
])
def test_what_is_beside_a_text_stays_out(beside):
    beside = beside.format(LONG + "No.", LONG[:90])
    assert page_text.page_text(f"<body><div><p>{LONG}</p></div>{beside}</body>") == LONG.strip()
    assert page_text.page_text(f"<form><div><p>{LONG}</p></div>{beside}</form>") == LONG.strip()


DUTCH = "Het weer blijft deze week wisselvallig en koud, met buien die vanuit zee over het hele land trekken en veel wind langs onze kust. " * 2
PORTUGUESE = "Os moradores da aldeia reuniram-se ontem à noite na praça para ouvir o presidente da câmara, que prometeu novas estradas e uma escola. " * 2
POLISH = "Wczoraj wieczorem mieszkańcy wsi zebrali się na rynku, żeby wysłuchać burmistrza, który obiecał nowe drogi oraz szkołę dla dzieci. " * 2


@pytest.mark.parametrize("text", [DUTCH, PORTUGUESE, POLISH])
@pytest.mark.parametrize("line", ["", "<p>This is the only line of the page that is in English, and it is not a long one.</p>"])
def test_pages_of_languages_without_stop_words(text, line):
    page = f"<body><ul><li><a href=a>Menu</a><li><a href=b>More of it</a></ul><div><p>{text}</p>{line}<p>{text}</p></div></body>"
    got = page_text.page_text(page).split("\n")
    assert got[0] == got[-1] == text.strip() and len(got) == 2 + bool(line)


def test_page_text_loses_no_block_of_an_unmarked_article():
    rights = LONG + "The sign © stands here for the rights of an author. " + LONG
    code = "for (int i = 0; i < n; i++) { total[i] += weight[i] * value[i]; } return total;".replace("<", "&lt;")
    page = f"<div><p>{LONG}</p><p>{rights}</p><pre>{code}</pre><p>{LONG}</p><p>{POLISH}</p><p>{LONG}</p><p>© 2020 The site, all rights reserved by it</p></div>"
    want = [LONG, rights, code.replace("&lt;", "<"), LONG, POLISH, LONG]
    assert page_text.page_text(page).split("\n") == [w.strip() for w in want]


@pytest.mark.parametrize("loose", ['title="5" tall"', "title='5' tall'", 'alt=5"', 'a="x>y" b', "data-id=nav", 'x = "a" "b', "it's"])
def test_a_loose_quote_in_a_tag_swallows_no_text(loose):
    page = f"<div><p {loose}>{LONG}</p><p class=\"x\">{LONG}Two.</p><p>{LONG}Three's \"end\".</p></div>"
    assert page_text.page_text(page).split("\n") == [LONG.strip(), LONG + "Two.", LONG + "Three's \"end\"."]


def test_very_long_pages_are_read_whole():
    page = "<div>" + f"<p>{LONG}</p>" * 20_000 + "</div>"
    assert page_text.page_text(page) == "\n".join([LONG.strip()] * 20_000)


def test_page_text_of_a_table(spark):
    df = spark.createDataFrame([(1, "<p>a b</p>", "t"), (1, "<p>a b</p>", "t"), (None, None, "t")], "key long, markup string, text string")
    assert sorted(map(str, (tuple(r) for r in page_text.main_text(df).collect()))) == ["(1, 'a b')", "(1, 'a b')", "(None, '')"]
    assert page_text.main_text(df.where("false")).collect() == []


@pytest.mark.parametrize(("a", "b"), [
    ([1, 2, 3, 4], [1, 9, 3, 4]), ([1, 1, 2, 1], [1, 2, 1, 1]), ([1, 2], [3, 4]), ([], [1]), ([5, 6, 7, 1, 2], [1, 2, 5, 6, 7]), ([3, 3, 3], [3, 3]),
])
def test_patience_aligns_in_order(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert bool(pairs) == bool(set(a) & set(b))


def test_repeated_passages_go_from_later_glosses(spark, prose):
    x, y, z = (prose(i) for i in (1, 2, 3))
    first = x.split("\n")
    rows = [(5, x, "a"), (7, y + "\n" + first[1].upper() + "\nshort line", "b"), (8, z + "\n\nshort line", "c"), (9, x, "d"),
            (10, "\n".join([first[3], "new words of this text only are here today", first[0]]), "e"), (11, None, "f"), (12, "", "g"), (None, x, "h"), (13, x, "i"), (13, x, "i")]
    df = spark.createDataFrame(rows, "key long, gloss string, removed string").repartition(3)
    out = {(r["key"]): (r["gloss"], r["removed"]) for r in line_dedup.remove_repeated_lines(df).collect()}
    assert out[5] == (x, 0) and out[7] == (y + "\nshort line", 1) and out[8] == (z + "\n\nshort line", 0)
    assert out[9] == ("", 4) and out[10] == ("new words of this text only are here today", 2)
    assert out[11] == (None, 0) and out[12] == ("", 0) and out[None] == (x, 0) and out[13] == ("", 4)
    assert line_dedup.remove_repeated_lines(df).count() == 10
    assert line_dedup.remove_repeated_lines(df.where("false")).collect() == []


def _shared_by_hand(a, b, least):
    """Lines of ``b`` in runs of lines that ``a`` has too, with enough words."""
    out = set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(len(x.split()) for x in b[j:j + n]) >= least:
                out |= set(range(j, j + n))
    return out


def _random_glosses(seed, n):
    rng = random.Random(seed)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 2, 2, 3, 4, 5, 9, 12]))) for _ in range(18)]
    texts = [rng.choices(lines, k=rng.randint(1, 9)) for _ in range(n)]
    # Pieces of earlier glosses, moved and repeated.
    for i in range(10, n, 2):
        a, b = texts[rng.randrange(i)], texts[rng.randrange(i)]
        texts[i] = b[len(b) // 2:] + [rng.choice(lines)] + a[:4] + b[:len(b) // 2 + 1]
    return texts


@pytest.mark.parametrize("seed", [3, 4])
def test_lines_shared_with_any_earlier_gloss_go_and_no_others(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "HEAVY", 8)
    monkeypatch.setattr(line_dedup, "HEAVY_ROWS", 3)
    texts = _random_glosses(seed, 90)
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(texts)], "key long, gloss string").repartition(3)
    gone = {r["key"]: set(r["lines"]) for r in line_dedup.repeated_lines(df).collect()}
    for key, text in enumerate(texts):
        must = set().union(*(_shared_by_hand(x, text, 8) for x in texts[:key]))
        assert gone.get(key, set()) == must


def test_blocks_out_of_order_are_aligned_on_their_own():
    rng = random.Random(9)
    for _ in range(400):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        size = [1, 2, 2, 3, 5, 8, 9]
        text = lambda x: [" ".join([str(v)] * size[v]) for v in x]
        found = line_dedup.common_lines(a, b, [size[v] for v in a], [size[v] for v in b], 8)
        must = _shared_by_hand(text(a), text(b), 8)
        assert set(found) <= must
        assert {i for h, start, end in line_dedup.passages(b, [size[v] for v in b], 8) for i in range(start, end)
                if h in {p[0] for p in line_dedup.passages(a, [size[v] for v in a], 8)}} <= set(found)
        assert set(found) == must


def _component_by_hand(sets, least):
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= least * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [top(i) for i in range(len(sets))]


@pytest.mark.parametrize(("words", "least"), [(3, 90), (5, 80)])
def test_near_copies_equal_brute_force(spark, words, least):
    rng = random.Random(words)
    base = [[rng.choice("abcdefghijklmnopqrst") + str(rng.randint(0, 30)) for _ in range(rng.choice([1, 2, 4, 30, 60, 120]))] for _ in range(25)]
    shared = [f"s{i}" for i in range(40)]
    texts = []
    for _ in range(160):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        texts.append(" ".join(shared + t if rng.random() < 0.3 else t))
    texts += [texts[0].upper(), "", " \n\t ", "a", "A", "é É", "É é"]

    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets = [shingles(t) for t in texts]
    df = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)], "key long, gloss string, component int, n string").repartition(3)
    out = {r["key"]: (r["n_shingles"], r["component"]) for r in near_copies.near_copies(df, words=words, percent=least).collect()}
    assert out == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, _component_by_hand(sets, least), strict=True))}


def test_near_copies_of_odd_rows(spark, prose):
    x, y = prose(1), prose(2)
    rows = [(3, x), (3, x), (4, None), (None, x), (6, x), (6, y), (9, y), (10, "")]
    out = near_copies.near_copies(spark.createDataFrame(rows, "key long, gloss string")).collect()
    assert sorted((str(r["key"]), str(r["component"])) for r in out) == sorted(
        [("3", "3"), ("3", "3"), ("4", "4"), ("None", "None"), ("6", "3"), ("6", "3"), ("9", "3"), ("10", "10")])
    assert near_copies.near_copies(spark.createDataFrame([], "key long, gloss string")).collect() == []


class _Caught(Exception):
    """Carries the work that an operator hands to Spark."""

    def mapInArrow(self, work, kinds):
        raise _Caught(work)


def test_workers_of_near_copies_hold_little(monkeypatch):
    """What another operator kept is dropped, and counting needs little beside the tokens counted together; counts are right."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 2000, 60)) for _ in range(2500)] + ["the same words here again and again"] * 5 + [None, ""]
    monkeypatch.setattr(near_copies, "COUNTED", 100_000)
    monkeypatch.setattr(near_copies, "BATCH_CHARS", 10_000)
    monkeypatch.setattr(memory, "_kept", {("word scores", "a model"): np.ones(10)})
    with pytest.raises(_Caught) as caught:
        near_copies._common_tokens(_Caught(), 5)
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "gloss": texts})
    tracemalloc.start()
    out = list(caught.value.args[0](iter([batch.slice(0, 1300), batch.slice(1300)])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not memory._kept
    assert most < 2.5 * 8 * 100_000
    tokens = np.concatenate(near_copies.shingle_sets(texts, 5)).view(np.int64).tolist()
    wanted = Counter()
    for start in range(0, len(tokens), 100_000):
        wanted.update({k: n for k, n in Counter(tokens[start:start + 100_000]).items() if n >= 3})
    found = Counter()
    for b in out:
        found.update(dict(zip(*(c.to_pylist() for c in b.columns), strict=True)))
    assert found == wanted and max(found.values()) >= 5


def test_parts_by_size_hold_every_row_and_give_memory_back(monkeypatch):
    released = []
    monkeypatch.setattr(memory, "RELEASE_CHARS", 50)
    monkeypatch.setattr(memory, "release", lambda: released.append(1))
    texts = ["a" * 30, None, "", "b" * 5, "ü" * 9, "c", None, "d" * 40]
    batch = pa.RecordBatch.from_pydict({"key": list(range(16)), "gloss": texts * 2})
    parts = list(memory.by_size(iter([batch.slice(0, 0), batch, batch.slice(3, 4)]), 10))
    assert [k for p in parts for k in p.column("key").to_pylist()] == [*range(16), 3, 4, 5, 6]
    for p in parts:
        sizes = [len(t or "") for t in p.column("gloss").to_pylist()]
        assert sum(sizes[:-1]) <= 10
    assert len(released) >= 2


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(50)] + [(5, 5), (1, 2), (2, 1)]
    out = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 100 for i in range(100, 161)} | {7: 7} | {1000 + i: 7 for i in range(50)} | {1: 1, 2: 1}
