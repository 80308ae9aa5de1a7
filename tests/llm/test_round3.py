"""Whitening, clustering and personal data against brute force, and on odd inputs."""

import hashlib
import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from oracle_check import compare, connect
from tidewater.llm import language, neardup, pii, whitening, zone_clusters
from tidewater.llm.tables import read

VECTORS = "vec_id bigint, embedding array<float>, id string, x int, cluster string"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, "b") for i, v in rows], VECTORS)


# --- clustering ---------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    order = zone_clusters.hilbert(points, bits)
    assert sorted(order) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(order)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_boxes_rule_out_only_what_cannot_win():
    rng = np.random.default_rng(1)
    for _ in range(200):
        points = rng.integers(-4, 5, size=(6, 3)) + rng.integers(-9, 10, size=3)
        centroids = rng.integers(-9, 10, size=(5, 3))
        centroids[4] = centroids[rng.integers(0, 4)]
        allowed = zone_clusters.candidates(points.min(axis=0), points.max(axis=0), centroids)
        every = zone_clusters.nearest(points, centroids, np.arange(5))
        some = zone_clusters.nearest(points, centroids, allowed)
        assert (every[0] == some[0]).all() and (every[1] == some[1]).all()


def brute_clusters(rows, length=64, scale=1024, clusters=8, rounds=10):
    kept = [(i, [int(np.floor(np.float64(scale) * np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == length and all(c is not None and np.isfinite(c) for c in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:clusters]
    centroids = [x for _, x in first]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        chosen = [near(x)[1] for _, x in kept]
        for k in range(len(centroids)):
            own = [x for (_, x), c in zip(kept, chosen) if c == k]
            if own:
                centroids[k] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *reversed(near(x))) for i, x in kept]
    inertia = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), hashes[k]) for i, k, d in found), key=str)


def test_clusters_equal_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) + i % 3).astype(np.float32).tolist()) for i in range(150)]
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(80)]  # a third of all rows
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]  # repeats, and a row without an id
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [NAN] * 64), (304, [INF] + [0.0] * 63), (305, [None] + [0.0] * 63)]
    got = zone_clusters.cluster(vectors(spark, rows), "vec_id", "embedding")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors_make_few_clusters(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    got = zone_clusters.cluster(vectors(spark, rows), "vec_id", "embedding")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows)


def test_entries_too_large_for_exact_distances_fail(spark):
    with pytest.raises(Exception, match="entries beyond"):
        zone_clusters.cluster(vectors(spark, [(1, [1e9] * 64)]), "vec_id", "embedding").collect()


def test_clusters_match_sql(spark):
    assert compare(spark, connect(SMALL), "op13_zone_map_clusters", SMALL) is None


# --- whitening ----------------------------------------------------------------


def rotation(rng, n):
    return np.linalg.qr(rng.normal(size=(n, n)))[0].astype(np.longdouble)


@pytest.mark.parametrize(
    "spectrum",
    [
        [9, 7, 5, 3, 2, 1],
        [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 - 1e-10, 0.1],  # clusters that float32 cannot tell apart
        [1, 1 - 1e-13, 0.3, 0.2, 0.1, 0.05],
        [2, 2, 2, 1, 1, 0],  # equal ones
        [1e12, 1, 1e-3, 0, 0, 0],
    ],
)
def test_refined_eigenvectors(spectrum):
    rng = np.random.default_rng(2)
    q = rotation(rng, len(spectrum))
    # Orthogonal beyond double precision.
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(q), dtype=np.longdouble) - 0.5 * (q.T @ q))
    wanted = np.array(spectrum, np.longdouble)
    a = (q * wanted) @ q.T
    values, x = whitening.refined_eigh((a + a.T) / 2)
    size = float(wanted.max())
    assert np.abs(values - wanted).max() <= 1e-17 * size
    assert np.abs(x.T @ x - np.eye(len(q))).max() <= 1e-17
    assert np.abs(a @ x - x * values).max() <= 1e-17 * size
    for i in range(len(q)):
        gap = np.abs(np.delete(wanted, i) - wanted[i]).min() / size
        if gap > 1e-14:
            off = min(np.abs(x[:, i] - q[:, i]).max(), np.abs(x[:, i] + q[:, i]).max())
            assert off <= max(1e-17, 1e-17 / gap)


def exact_covariance(xs):
    n, d = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(d)]
    cov = [[Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in xs), n**3) for j in range(d)] for i in range(d)]
    return n, s, cov


@pytest.mark.parametrize("shift", [0, 4096, -1.0e6])
def test_whitening_equals_exact_sums(spark, shift):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 6)) @ rng.normal(size=(6, 6)) + shift
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [(3, rows[3][1]), (None, rows[4][1])]
    rows += [(900, None), (901, [NAN] * 6), (902, [None] + [1.0] * 5), (903, [1.0]), (904, [])]
    got = whitening.whiten(vectors(spark, rows), "vec_id", "embedding").collect()
    used = [(i, [int(np.floor(256 * np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == 6 and not any(c is None or np.isnan(c) for c in v)]
    distinct = [list(x) for x in {tuple(x) for _, x in used}]
    n, s, cov = exact_covariance(distinct)
    assert len(got) == 4 * len(used) and {r["n"] for r in got} == {n}
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    assert max(r["identity_error"] for r in got) < 1e-9
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["component"]), []).append(r)
    signs = {}
    for i, x in used:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        y = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)])
        for k in range(4):
            w = y @ axes[:, k] / np.sqrt(values[k])
            for r in by_row[i, k + 1]:
                assert r["deviation"] == deviation
                assert abs(r["explained"] - values[k] / sum(values)) < 1e-9
                if abs(w) > 1e-3:
                    signs.setdefault(k, np.sign(w * r["whitened"]))
                assert abs(abs(w) - abs(r["whitened"])) < 1e-8
                assert abs(w) < 1e-3 or np.sign(w * r["whitened"]) == signs[k]


def test_deviation_beyond_64_bits_is_null_and_large_entries_stay_exact(spark):
    rows = [(0, [1.0e12, 0.0]), (1, [-1.0e12, 3.0]), (2, [5.0e11, -3.0])]
    got = whitening.whiten(vectors(spark, rows), "vec_id", "embedding").collect()
    assert {r["deviation"] for r in got} == {None}
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(vectors(spark, rows), "vec_id", "embedding")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]
    got = whitening.whiten(vectors(spark, rows), "vec_id", "embedding")
    assert {r["component"] for r in got.collect()} == {1}


# --- personal data --------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def card(rnd, n=16):
    digits = "".join(str(rnd.randint(0, 9)) for _ in range(n - 1))
    return next(digits + str(c) for c in range(10) if luhn(digits + str(c)))


def odd_texts():
    rnd = random.Random(5)
    out = []
    for _ in range(1500):
        letters = rnd.choice(["ab.@-_ ", "12. -", "+1(). -2", "1234567890 -+.@aé😀\n", "@a.b@c"])
        out.append("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))))
    for _ in range(50):
        n = card(rnd)
        out.append(f"x 😀 {n[:4]} {n[4:8]} {n[8:12]}-{n[12:]} and {n} a.b@c.de_f@g.h 1.2.3.4.5.6.7.8 +1 (234) 555-3333 000255.1.1.1 256.1.1.1")
    long = ["a" * 100_000 + " 1.2.3.4", "1 " * 50_000, "1.2.3.4 " * 5_000, "a@b." + "c." * 20_000 + "d", "+1 " * 20_000]
    return [*out, *long, None, "", " \n"]


def test_base_spans_equal_brute_force(spark):
    texts = odd_texts()
    rows = [(i, t, "en", "s", 0, "x", "y", "z") for i, t in enumerate(texts)] + [(3, texts[-6], "en", "s", 0, "x", "y", "z"), (None, "a@b.c", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, id string, label string")
    got = pii.digests(pii.find(docs.repartition(8))).collect()
    assert len(got) == len(rows)
    by_id = {(r["doc_id"], r["base_sha256"]): r for r in got}
    for i, text, *_ in rows:
        want = base_spans(text)
        r = by_id[i, hashlib.sha256(",".join(want).encode()).hexdigest()]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k + ":") for w in want) for k in PATTERNS]
        have = [s for s in r["spans"].split(",") if s]
        assert set(want) <= set(have) and r["n_added"] == len(have) - len(want)
        kinds = list(PATTERNS)
        assert have == sorted(have, key=lambda s: (kinds.index(s.split(":")[0]), *map(int, s.split(":")[1:])))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.digests(pii.find(docs)).collect() == []


def examples(n=600):
    """Texts with plain data, with things that look like it, and with spelled-out forms to be found."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8)))
    rows, hidden = [], []
    for i in range(n):
        plain = rnd.choice(
            [
                f"mail {word()}@{word()}.com now",
                f"call +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)} today",
                f"card {card(rnd)} ok",
                f"look at {word()} and {word()}",
                f"order {rnd.randint(1000, 9999)}{rnd.randint(1000, 9999)}{rnd.randint(1000, 9999)}9999 shipped",
                f"on {rnd.randint(1, 28)}.{rnd.randint(1, 12)}.2020 at {word()}",
                f"key a{rnd.randint(10**9, 10**10)}f end",
                f"met at {word()} 42",
            ]
        )
        if i % 30 == 7:
            spelled = f"{word()} [at] {word()} [dot] org"
            hidden.append((i, "email", spelled))
            plain = f"mail {spelled} now"
        rows.append((i, f"{word()} {plain} {word()}"))
    return rows, hidden


def test_model_finds_spelled_out_addresses_and_leaves_prose_alone(spark):
    rows, hidden = examples()
    got = {r["doc_id"]: r for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    text = dict(rows)
    for i, kind, spelled in hidden:
        start = text[i].index(spelled)
        assert got[i]["spans"] == f"{kind}:{start}:{start + len(spelled)}"
    for i in text.keys() - {h[0] for h in hidden}:
        assert got[i]["n_added"] == 0, text[i]


def test_redaction_covers_overlapping_spans(spark):
    row = spark.range(1).select(
        pii.redact(
            F.lit("é 12 ab 34"),
            F.expr("array(struct(5L as start, 7L as end, 'b' as kind), struct(2L as start, 6L as end, 'a' as kind), struct(8L as start, 10L as end, 'c' as kind))"),
        ).alias("t")
    )
    assert row.first()["t"] == "é [a] [c]"


def test_personal_data_runs_no_python(spark):
    found = pii.digests(pii.find(read(spark, SMALL, "documents")))
    plan = found._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- near duplicates of documents that share an id ----------------------------------


def shingle_set(text, width):
    words = (text or "").lower().split()
    k = min(width, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_rows(rows, width, percent):
    """Component of every row, each a node of its own text; equal texts are one node."""
    texts = {t: shingle_set(t, width) for _, t in rows}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        both = len(texts[a] & texts[b])
        if texts[a] and texts[b] and 100 * both >= percent * len(texts[a] | texts[b]):
            root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if texts[t] and i is not None:
            least[find(t)] = min(least.get(find(t), i), i)
    return sorted((i, len(texts[t]), least[find(t)] if texts[t] and i is not None else i) for i, t in rows)


def test_groups_of_ids_with_several_texts_equal_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rnd.choice(words) for _ in range(200)) for _ in range(12)]
    near = lambda t: " ".join(rnd.choice(words) if rnd.random() < 0.008 else w for w in t.split())
    rows = [(9, base[0]), (7, near(base[0])), (7, base[1]), (8, near(base[1]))]  # 8 and 9 share nothing
    rows += [(20 + i, near(base[rnd.randint(0, 5)])) for i in range(40)]
    rows += [(20 + i, near(base[rnd.randint(4, 11)])) for i in range(0, 40, 3)]
    rows += [(21, base[2]), (21, base[2]), (5, base[6]), (5, base[7]), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.groups(docs, 3, 85).collect())
    assert got == brute_rows(rows, 3, 85)


# --- texts of no learned language ------------------------------------------------------


def test_texts_of_other_languages_and_junk_go_and_learned_ones_stay(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rnd = random.Random(1)
    letters = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(n))
    planted = [
        "Сегодня утром мы пошли в парк и долго гуляли по дорожкам среди деревьев",
        "今日は朝から公園に行って、木々の間を長い間歩きました。とても楽しかったです",
        letters(60),
        letters(500),
        "qwxz zxqw " * 50,
    ]
    schema = docs.schema
    rows = [(10**6 + i, t, "en", "planted", len(t)) for i, t in enumerate(planted)] + [(10**6 + 50, "the", "en", "planted", 3)]
    every = docs.unionByName(spark.createDataFrame(rows, schema))
    kept = {r["doc_id"] for r in language.keep_known(every, language.train(docs)).select("doc_id").collect()}
    assert not kept & {10**6 + i for i in range(len(planted))} and 10**6 + 50 in kept
    held = {r["doc_id"] for r in docs.where("crc32(CAST(doc_id AS STRING)) % 5 = 0").select("doc_id").collect()}
    assert len(held & kept) >= 0.99 * len(held)
    assert len(kept) >= 0.99 * docs.count()
