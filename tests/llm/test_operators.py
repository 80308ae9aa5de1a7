"""Operators against brute force, exact round trips, held-out accuracy and odd inputs."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import charlm, chat, components, decontaminate, html_text, language, neardup, neighbours, packing, quality, text, toxicity, urls
from tidewater.llm.superminhash import signature
from tidewater.llm.tables import fold, read

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, ids string"
LABELS = "doc_id bigint, quality int, toxic int"


def doc(i, text, lang="en"):
    return (i, text, lang, "s", len(text or ""), "x", "y", "z")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x" for i in range(60_000))
    rows = [doc(1, None), doc(2, ""), doc(3, "  \n\t"), doc(4, "one"), doc(5, long), doc(6, long), doc(7, "a b c d e f g h"), doc(7, "a b c d e f g h")]
    return spark.createDataFrame([*rows, doc(None, "no id here at all"), doc(8, "12 34 ..", None)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 1), (7, None, None), (None, 1, 1), (99, 1, 1)], LABELS)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    k = min(width, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    for share, n in ((0.85, 300), (0.3, 100), (0.6, 9000)):
        found = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
            k = int(share * n)
            half = (n - k) // 2
            found.append((signature(np.r_[pool[:k], pool[k : k + half]], 120) == signature(np.r_[pool[:k], pool[k + half :]], 120)).mean())
        assert abs(np.mean(found) - k / n) < 0.03
    assert np.isinf(signature(np.zeros(0, np.uint64), 8)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 160))


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, width, percent):
    rng = random.Random(width)
    base = [f"t{rng.randint(0, 400)}" for _ in range(120)]
    rows = []
    for i in range(160):
        words = list(base if i % 2 else [f"u{i % 5}v{j}" for j in range(90)])
        for _ in range(rng.choice((0, 0, 1, 2, 3, 5, 9))):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 9999)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.groups(docs, width, percent).collect()}
    want = brute_groups(rows, width, percent)
    assert found == {i: (n, c, c == i) for i, (n, c) in want.items()}
    assert sorted(r["doc_id"] for r in neardup.keep_one(docs, width, percent).collect()) == sorted({c for _, c in want.values()})


def test_near_duplicates_match_brute_force_on_documents(spark):
    docs = read(spark, SMALL, "documents")
    want = brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.groups(docs, 3, 85).collect()} == want


def test_near_duplicates_of_odd_rows(odd, none):
    found = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.groups(odd, 3, 85).collect()))
    assert [f for f in found if f[0] in (0, 1, 2, 3)] == [(0, 3, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert [(f[0], f[2], f[3]) for f in found if f[0] >= 4] == [(4, 4, True), (5, 5, True), (6, 5, False), (7, 7, True), (7, 7, True), (8, 8, True)]
    assert neardup.keep_one(odd).columns == odd.columns and neardup.keep_one(odd).count() == odd.count() - 1
    assert neardup.groups(none).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_bands_hold_their_bound_at_every_threshold(spark, percent):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id bigint, text string")
    keys = len(neardup.sketch(docs, 5, percent).first()["bands"])
    assert (1 - (percent / 100) ** neardup.BAND_SLOTS) ** keys < 1e-6


def test_packing_plan_is_tight_and_gapless():
    rng = np.random.default_rng(0)
    for counts in (np.bincount(rng.integers(1, 2049, 5000), minlength=2049), np.bincount([700] * 99 + [648] * 50 + [3], minlength=2049), np.zeros(2049, int)):
        steps, used = packing.plan(counts), {}
        seen = np.zeros(2049, int)
        for length, first, n, sequence, offset in steps.tolist():
            assert first == seen[length]
            seen[length] += n
            for s in range(sequence, sequence + n):
                assert used.get(s, 0) == offset
                used[s] = offset + length
        assert (seen == counts).all() and max(used.values(), default=0) <= 2048
        total = int((counts * np.arange(2049)).sum())
        assert len(used) <= total / 2048 * 1.03 + 2


@pytest.mark.parametrize("size", ["odd", "none", "documents"])
def test_packing_keeps_every_token(spark, odd, none, size):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = {"odd": odd, "none": none}.get(size) if size != "documents" else read(spark, SMALL, "documents")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(
        (r["doc_id"] or 0, zlib.crc32(np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()))
        for r in docs.select("doc_id", "text").collect()
    )
    pieces = packing.tokenize(docs, with_ids=True)
    packed = packing.pack(pieces).collect()
    whole, at = {}, {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert at.get(r["sequence_id"], 0) == r["offset"] and 0 < r["length"] == len(r["ids"])
        at[r["sequence_id"]] = r["offset"] + r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert max(at.values(), default=0) <= 2048
    if size == "documents":
        for r in packed:
            whole.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
        assert want == sorted((i, zlib.crc32(np.array(sum((p[k] for k in sorted(p)), []), "<u4").tobytes())) for i, p in whole.items())
    assert sum(r["length"] for r in packed) == sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    for r in packing.sequences(packing.pack(pieces)).collect():
        assert len(r["ids"]) == (r["length"] if r["length"] & (r["length"] - 1) == 0 else 2048)


def test_tokens_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, tokens, rng = Tokenizer.from_file(path), packing.Tokens(path), random.Random(3)
    signs = "abST.,' éÉßµÀ×÷ÿª½²\x85\xa0\xad\x1c\n\t12<|!?Σςİſ漢́"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|ENDOFTEXT|>", "it's WE'LL", None]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert tokens.of(texts) == want


def test_tokens_encode_every_word_once_whatever_stands_around_it(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, tokens = Tokenizer.from_file(path), packing.Tokens(path)
    texts = [f"Été, ({w})-{i}! it's {w}***{i * 37}.{w}\t" for i, w in enumerate(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))]
    texts += ["", None, "x \u0301 H\u0331 'S ,'s <|ENDOFTEXT|>a<|endoftext|>, it'sa1e\u0301.É,×é", " ".join(["a1, bé."] * 90)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    asked = []

    class Whole:
        def encode_batch(self, chunks, **options):
            asked.extend(chunks)
            return tokenizer.encode_batch(chunks, **options)

    tokens._tokenizer = Whole()
    assert tokens.of(texts) == want
    assert len(asked) < 40
    # Steps that end within texts, slices of Arrow columns and turns of the memory change nothing.
    monkeypatch.setattr(packing, "STEP_BYTES", 64)
    monkeypatch.setattr(packing, "KNOWN_CHUNKS", 20)
    assert packing.Tokens(path).of(pa.array(["b", *texts, "b"]).slice(1, len(texts))) == want


def test_nearest_neighbours_reach_recall(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(2500, 24))
    base[100:300] = base[7]  # copies of one vector
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(base)]
    bad = [(9000, None, 1), (9001, [0.0] * 24, 1), (9002, [float("nan")] * 24, 1), (9003, [1.0, None] * 12, 1), (9004, [1.0], 1), (None, [1.0] * 24, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, score int")
    sizes = neighbours.BLOCK, neighbours.PART
    neighbours.BLOCK, neighbours.PART = 400, 500
    try:
        found = neighbours.nearest(df, "vec_id", "embedding", F.col("id") % 20 == 0).collect()
    finally:
        neighbours.BLOCK, neighbours.PART = sizes
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 2500, 20):
        score = base @ base[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(2500), -np.round(score, 9)))[:20]
        assert len(got[q]) == 20 and all(abs(score[i] - s) < 1e-9 for i, s in got[q])
        hits += len(set(best.tolist()) & {i for i, _ in got[q]})
    assert len(got) == 125 and hits >= 0.9 * 125 * 20
    assert [i for i, _ in got[100]][:3] == [7, 101, 102]


def test_nearest_neighbours_of_few_and_none(spark):
    kind = "vec_id bigint, embedding array<float>"
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], kind), "vec_id", "embedding", F.col("id") == 0)
    assert [(r["rank"], r["vec_id"], r["score"]) for r in few.orderBy("rank").collect()] == [(1, 2, 1.0), (2, 1, 0.5)]
    assert neighbours.nearest(spark.createDataFrame([], kind), "vec_id", "embedding", F.col("id") == 0).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0])], kind), "vec_id", "embedding", F.col("id") == 0).count() == 0


def test_nearest_neighbours_move_arrays_between_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # Clusters, and a component that is large in all vectors and says nothing.
    base = rng.normal(size=(40, 1, 16)) + 0.4 * rng.normal(size=(40, 75, 16))
    base = base.reshape(-1, 16)[rng.permutation(3000)]
    base[:, 3] = 30 + 0.01 * base[:, 3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(neighbours, "PART", 100)
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    stored, keep = [], neighbours.keep

    def counting(df):
        stored.append(keep(df))
        return stored[-1]

    monkeypatch.setattr(neighbours, "keep", counting)
    runs = [sorted(map(tuple, neighbours.nearest(df, "vec_id", "embedding", F.col("id") % 30 == 0).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    hits = 0
    for q in range(0, 3000, 30):
        score = base @ base[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & {r[2] for r in runs[0] if r[0] == q})
    assert hits >= 0.95 * 100 * 20
    # A row a vector in four tables only, whatever the number of iterations, starting blocks and rounds.
    rows = [t.count() for t in stored]
    assert sum(n >= 3000 for n in rows) == 2 * 4


def test_nearest_neighbours_of_wide_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 200)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base[:150])]
    # Ids with two vectors, rows that occur twice, copies of one vector under other ids.
    rows += [(i, v.tolist()) for i, v in enumerate(base[150:])] + rows[:20] + [(1000 + i, base[7].tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(df, "vec_id", "embedding", F.col("id") == 1003).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(i + 1, v) for i, v in enumerate([7, *(i for i in range(1000, 1020) if i != 1003)])]
    got = neighbours.nearest(df, "vec_id", "embedding", F.col("id") == 11, k=2).collect()
    pairs = {(r["rank"], r["vec_id"], round(r["score"], 6)) for r in got}
    want = set()
    ids = np.arange(300) % 150
    for v in (11, 161):
        score = base.astype(float) @ base[v].astype(float)
        score[ids == 11] = -np.inf
        want |= {(rank + 1, int(ids[i]), round(float(score[i]), 6)) for rank, i in enumerate(np.argsort(-score)[:2])}
    assert pairs == want


def test_chat_reads_back_what_it_wrote(spark):
    texts = ["plain", "", None, "</s>[INST] ok [/INST]", "\\", "a\\", "\\</s>", "<\\/s>", "x [/INST]</s><s>[INST:user] y", "[/INST]", "\n", "é漢\U0001f600</s>", "</s>" * 50, " [/INST]"]
    roles = ["user", "assistant", None, "a]b", "%5D<x>", "system\n", "</s>"]
    rows = [(i // 5, i % 5, roles[i % len(roles)], t, 7) for i, t in enumerate(texts * 7)] + [(None, None, "user", "lost", 7), (3, 1, "assistant", "tie", 7)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, level int")
    found = chat.format_conversations(df)
    assert found.where("not identical").count() == 0
    digests = {r["conv_id"]: r for r in chat.digests(found).collect()}
    spans = {r["conv_id"]: r for r in found.collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        d = digests[conv]
        assert (d["n_turns"], d["loss_chars"]) == (len(own), len(loss))
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert d["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and d["formatted_chars"] == len(spans[conv]["formatted"])
        bodies = [spans[conv]["formatted"][s["start"] : s["end"]] for s in spans[conv]["loss_spans"]]
        assert len(bodies) == sum(r == "assistant" for _, r, _ in own)
        assert all(b == x for b, (_, _, x) in zip(bodies, [o for o in own if o[1] == "assistant"]) if "\\" not in x and "</s>" not in x)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
    assert "Python" not in chat.digests(found)._jdf.queryExecution().toString()


def test_chat_loss_is_read_from_its_spans(spark):
    rows = [(1, 0, "user", "question"), (1, 1, "assistant", "an\\swer </s>"), (1, 2, "assistant", "more")]
    found = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    moved = found.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["end"])))
    for df, loss in ((found, "an\\swer </s>more"), (moved, "n\\swer </s>ore")):
        (got,) = chat.digests(df).collect()
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_decontamination_matches_brute_force(spark, odd, none):
    docs, items = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")

    def grams(text):
        words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()
        k = min(5, len(words))
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()

    held = {r["doc_id"]: grams(r["text"]) for r in docs.collect()}
    want = set()
    for r in items.collect():
        own = grams(r["text"])
        want |= {(i, r["item_id"], len(own), len(own & s)) for i, s in held.items() if own and 100 * len(own & s) >= 80 * len(own)}
    found = decontaminate.search(docs, items)
    assert {tuple(r)[:4] for r in found.collect()} == want and want
    assert {r["doc_id"] for r in decontaminate.keep_clean(docs, items).collect()} == set(held) - {w[0] for w in want}
    strange = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (4, "one")], "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.search(odd, strange).collect())
    assert got == [(4, 4), (7, 3), (7, 3), (7, 3), (7, 3)]
    assert decontaminate.search(none, items).count() == 0 and decontaminate.search(odd, items.limit(0)).count() == 0
    assert decontaminate.keep_clean(odd, items.limit(0)).count() == odd.count()


def test_decontamination_in_blocks(spark, monkeypatch):
    docs, items = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")
    whole = sorted(map(tuple, decontaminate.search(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 3)
    assert sorted(map(tuple, decontaminate.search(docs, items).collect())) == whole


def test_main_text_of_pages(spark):
    page = (
        '<html><head><title>x</title></head><body><header>Site</header><div class="cookie-notice">We use cookies, ok.</div>'
        '<article><h1>Head &amp; tail</h1><p><b>First,  one.<br>still<p>Ok.</p></article><aside>More.</aside>'
        '<section class="comments"><p>Nice, really nice!</p></section><form>Name</form><footer>&copy; us</footer></body></html>'
    )
    assert html_text.main_text(page) == "Head & tail\nFirst, one. still\nOk."
    plain = '<div id="content"><h2>T</h2><div><p>A long text, with marks. And more.</p><p>B.</p></div></div><div class="right-rail"><a>l</a></div>'
    assert html_text.main_text(plain) == "T\nA long text, with marks. And more.\nB."
    assert [html_text.main_text(x) for x in (None, "", "<p>", "<!-- a", "a < b &lt;")] == ["", "", "", "", "a < b <"]
    assert html_text.main_text("<p x='" * 3000 + "end") is not None
    df = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None)], "page_id bigint, url string, html string")
    assert sorted((r["page_id"], r["n_chars"]) for r in html_text.extract(df).collect()) == [(1, 33), (1, 33), (2, 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_main_text_below_named_elements():
    prose = "".join(f"<p>Sentence {i}, with marks, and of some length. It goes on for a while, as prose does.</p>" for i in range(6))
    text = "\n".join(f"Sentence {i}, with marks, and of some length. It goes on for a while, as prose does." for i in range(6))
    menu = '<ul class="menu">' + "".join(f"<li><a>Item {i}</a></li>" for i in range(8)) + "</ul>"
    head = '<div class="entry-header"><h1>Title here</h1></div>'
    form = f'<form id="aspnetForm"><div class="header">Site</div>{menu}<div id="content">{head}{prose}</div><div class="footer">Us</div></form>'
    assert html_text.main_text(form) == "Title here\n" + text
    share = '<div class="share"><a>Tweet</a> <a>Post</a></div>'
    page = f'<div class="page has-sidebar"><article>{head}{prose}{share}</article><div class="sidebar"><p>Buy now.</p>{menu}</div></div>'
    assert html_text.main_text(page) == "Title here\n" + text
    assert html_text.main_text(f"<label>{prose}</label>") == text
    assert html_text.main_text(f'<div id="c">{prose}</div><aside><article><p>Teaser, short. Read.</p></article></aside>') == text
    assert html_text.main_text(f'{menu}<div id="c">{prose}<ul><li><a>Next</a></li><li><a>Previous</a></li></ul></div>') == text
    assert html_text.main_text(f'<article><p>A <span class="legal">binding</span> word.</p>{prose}</article>') == "A binding word.\n" + text
    assert html_text.main_text('<div class="notice">Closed.</div>') == "Closed."


def test_url_rules_and_models(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/")]
    cases = [
        ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
        ("http://x.org?q", "x.org", "", None, None),
        ("nothing", "", "", None, None),
        (None, "", "", None, None),
    ]
    rows = [(i, c[0], 1) for i, c in enumerate(cases * 2)] + [(100 + i, f"http://good{i}.com/fine/{i}", 1) for i in range(60)]
    rows += [(200 + i, f"http://casino{i}.example.com/en/win/{i}", 1) for i in range(60)] + [(300, "http://casino7.net/en/win/9", 1), (301, "http://good3.net/fine/8", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, verdict int")
    found = {r["page_id"]: r for r in urls.judge(df, rules).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases * 2):
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == verdict or verdict is None and found[i]["verdict"] in ("allow", "block")
    assert found[300]["verdict"] == "block" and found[301]["verdict"] == "allow"
    assert urls.judge(df.limit(0), rules).count() == 0 and urls.judge(df, []).where("verdict <> 'allow'").count() == 0


def test_language_holds_out(spark, odd, none):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = language.predict(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = {r["doc_id"]: r for r in language.predict(odd, language.train(docs)).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3, 8)) and rows[5]["lang_pred"] != "und"
    assert {r["lang_pred"] for r in language.predict(odd, language.train(none)).collect()} == {"und"}
    assert language.predict(none, language.train(docs)).count() == 0
    assert language.keep_known(odd, language.train(docs)).columns == odd.columns


def test_toxicity_holds_out(spark, odd, none, labels):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng, rows, marks = random.Random(0), [], []
    for i in range(900):
        text = [rng.choice(words) + rng.choice(("a", "os", "ent")) for _ in range(40)]
        if i % 3 == 0:
            text[rng.randrange(40)] = "scumbag" + rng.choice(("s", "", "like"))
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(i % 3 == 0)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(marks, LABELS)
    model = toxicity.train(docs, known)
    found = toxicity.score(docs, model).join(known, "doc_id").where("held_out")
    assert found.where("predicted <> toxic").count() <= 0.02 * found.count()
    assert {r["held_out"] for r in toxicity.score(docs, model).where(fold() == 0).collect()} == {True}
    assert toxicity.keep_ordinary(odd, model).columns == odd.columns
    for m in (model, toxicity.train(odd, labels), toxicity.train(none, labels.limit(0))):
        scores = toxicity.score(odd, m).collect()
        assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.score(none, model).count() == 0


def test_language_models_keep_all_runs_apart(spark):
    """More distinct runs than any fixed number of buckets keeps apart, against the same models in plain dictionaries."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(30_000)]
    order, classes = toxicity.ORDER, [i % 3 for i in range(len(words))]
    grams = [Counter() for _ in range(3)]
    for w, c in zip(words, classes):
        signs = "\x02" * (order - 1) + w + "\x03"
        grams[c].update(signs[i : i + order] for i in range(len(signs) - order + 1))
    low = set().union(*grams)
    n, total, kinds = Counter(), Counter(), Counter()
    for _ in range(order - 1):
        shorter = Counter(g[1:] for g in low)
        n.update(shorter)
        for g, k in shorter.items():
            total[g[:-1]] += k
            kinds[g[:-1]] += 1
        low = set(shorter)
    held = [[Counter(), Counter()] for _ in range(2)]
    for c in (0, 1):
        for g, k in grams[c].items():
            held[c][0][g[:-1]] += k
            held[c][1][g[:-1]] += 1
    once = [[sum(k == m for k in grams[c].values()) for m in (1, 2)] for c in (0, 1)]

    def want(w):
        signs, sums = "\x02" * (order - 1) + w + "\x03", 0.0
        for i in range(order - 1, len(signs)):
            p = 1 / 5000
            for k in range(1, order):
                g = signs[i - k + 1 : i + 1]
                if total[g[:-1]]:
                    p = (max(n[g] - 0.75, 0) + 0.75 * kinds[g[:-1]] * p) / total[g[:-1]]
            g, logs = signs[i - order + 1 : i + 1], []
            for c in (0, 1):
                d, (seen, t) = once[c][0] / (once[c][0] + 2 * once[c][1]), (held[c][j][g[:-1]] for j in (0, 1))
                logs.append(np.log((max(grams[c][g] - d, 0) + d * t * p) / seen if seen else p))
            sums += logs[0] - logs[1]
        return sums

    docs = spark.createDataFrame(list(zip(words, classes)), "text string, class int")
    model = toxicity._tables(charlm.gram_counts(docs, order, 3, text.letter_words))
    some = words[:200]
    assert np.allclose(toxicity._word_scorer(model).rows([[w.encode() for w in some]])[0][:, 0], [want(w) for w in some], atol=1e-9)

    order, decided = urls.ORDER, spark.createDataFrame([(w[:4] + ".x", "/" + w[4:], ("allow", "block")[c % 2]) for w, c in zip(words, classes)], "host string, path string, decided string")
    model = urls.train(decided)
    rows = [(r["text"], r["class"]) for r in urls._split_rows(decided).where("not apart").collect()]
    counts, after, sort = ([Counter(), Counter()] for _ in range(3))
    for url, c in rows:
        signs = "\x02" * (order - 1) + url + "\x03"
        counts[c].update(signs[i - k + 1 : i + 1] for i in range(order - 1, len(signs)) for k in range(1, order + 1))
    for c in (0, 1):
        for g, k in counts[c].items():
            after[c][g[:-1]] += k
            sort[c][g[:-1]] += 1

    def difference(url):
        signs, sums = "\x02" * (order - 1) + url + "\x03", 0.0
        for i in range(order - 1, len(signs)):
            p = [1 / 256, 1 / 256]
            for k in range(1, order + 1):
                g = signs[i - k + 1 : i + 1]
                p = [(counts[c][g] + sort[c][g[:-1]] * p[c]) / (after[c][g[:-1]] + sort[c][g[:-1]]) if after[c][g[:-1]] else p[c] for c in (0, 1)]
            sums += np.log(p[0]) - np.log(p[1])
        return sums / (len(url) + 1)

    some = [u for u, _ in rows[:200]]
    assert np.allclose(urls._scorer(model)(some), [difference(u) for u in some], atol=1e-9)


def test_resampling(spark, odd, none, labels):
    docs, known = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    found = quality.resample(docs, known, share=0.8)
    assert found.where("kept").count() == 800 and found.count() == 1000
    least = found.where("kept").agg(F.min("gumbel_key")).first()[0]
    assert found.where("not kept").agg(F.max("gumbel_key")).first()[0] < least
    mean = {r["quality"]: r["w"] for r in found.join(known, "doc_id").groupBy("quality").agg(F.avg("log_weight").alias("w")).collect()}
    assert mean[1] > mean[0]
    rows = quality.resample(odd, labels, share=1.0).collect()
    assert {r["doc_id"] for r in rows if not r["kept"]} == {1, 2, 3} and len(rows) == odd.count()
    assert quality.resample(none, labels).count() == 0 and quality.resample(odd, labels.limit(0)).count() == odd.count()
    assert quality.kth_largest(spark.createDataFrame([(x,) for x in (-5, 7, 7, 2**62, -(2**62), None)], "x bigint"), "x", 3) == 7
