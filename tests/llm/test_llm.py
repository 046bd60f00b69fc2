"""The operators on training data: every defined case on small tables, against brute force where there is no SQL."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import fusion, leaks, quality, sampling, similar, tokens
from tests.conftest import as_set

RANKED = "build string, iri string, bucket string, rank int, score double, views bigint, languages int, loaded_at string, need string, prio int"
TARGETS = "draw_id bigint, build string, max_rank int, sample_size int, bucket string, target_permille int, min_rows int"
DOCS = "doc_id bigint, text string, lang string, h string, pos int, words string, n_chars bigint"


def doc(i, text, lang="en"):
    return (i, text, lang, "clash", 1, "clash", 0)


# ---------------------------------------------------------------- p1


def test_sampling(spark):
    rows = [("b", f"i{k}", " Cat\t" if k % 2 else "CAT", k, None, None, None, "1", "x", 0) for k in range(1, 101)] * 2
    rows += [("b", f"j{k}", "dog", k, None, None, None, "1", "x", 0) for k in range(1, 6)]
    rows += [("b", "j5", "cat", 5, None, None, None, "2", "x", 0), ("b", "k", None, 1, None, None, None, "1", "x", 0), ("b", "l", "dog", None, None, None, None, "1", "x", 0), ("c", "z", "cat", 1, None, None, None, "1", "x", 0)]
    targets = [(1, "b", 50, 40, "Cat", 500, 3), (1, "b", 50, 40, "dog", 10, 6), (1, "b", 50, 40, "fish", 0, 0), (1, "b", 50, 40, "bird", 25, 0), (1, "b", 50, 40, "Cat", 500, 3), (2, "b", 50, None, None, None, 1), (3, "b", 50, 39, "dog", 52, 1)]
    out = sampling.draw(spark.createDataFrame(rows, RANKED), spark.createDataFrame(targets, TARGETS))
    report = {(r["draw_id"], r["bucket"]): (r["need"], r["pool"], r["quota"], r["reason"]) for r in out.report.collect()}
    # draw 1: 40 rows, dog has 4 of its least 6, bird none; Cat gets all the rest
    assert report == {
        (1, "Cat"): (20, 51, 36, None), (1, "dog"): (6, 4, 4, "pool_below_need"), (1, "fish"): (0, 0, 0, None), (1, "bird"): (1, 0, 0, "pool_below_need"),
        (2, None): (1, 0, 0, "pool_below_need"), (3, "dog"): (2, 4, 4, "exhausted"),
    }
    sample = out.sample.collect()
    assert len({(r["draw_id"], r["iri"]) for r in sample}) == len(sample) == 44
    again = sampling.draw(spark.createDataFrame(rows, RANKED).repartition(7), spark.createDataFrame(targets, TARGETS)).sample
    assert as_set(again) == {tuple(r) for r in sample}


def test_sampling_is_uniform_and_mergeable(spark, monkeypatch):
    rows = [("b", f"i{k}", "cat", k, None, None, None, "1", "x", 0) for k in range(1, 401)]
    df, hits = spark.createDataFrame(rows, RANKED).repartition(5), {}
    targets = [(d, "b", 400, 40, "cat", 1000, 0) for d in range(60)]
    for r in sampling.draw(df, spark.createDataFrame(targets, TARGETS)).sample.collect():
        hits[r["iri"]] = hits.get(r["iri"], 0) + 1
    assert sum(hits.values()) == 60 * 40 and max(hits.values()) < 20 and len(hits) > 380
    empty = sampling.draw(spark.createDataFrame([], RANKED), spark.createDataFrame([], TARGETS))
    assert empty.sample.count() == 0 and empty.report.count() == 0


def brute_quotas(size, cats):
    """(weight, least, pool) -> real quotas by bisection on the common level."""
    low = [min(m, p) for _, m, p in cats]
    at = lambda t: [lo if w == 0 else max(lo, min(p, w * t)) for lo, (w, _, p) in zip(low, cats)]
    if sum(low) >= size:
        return low
    a, b = 0.0, 1e9
    for _ in range(200):
        a, b = ((a + b) / 2, b) if sum(at((a + b) / 2)) <= size else (a, (a + b) / 2)
    return at(a)


def test_quotas_are_within_a_row_of_the_solution(spark):
    rng = random.Random(11)
    draws = {d: (rng.choice([0, 10, 100, 1000]), [(rng.choice([0, 1, 40, 333]), rng.choice([0, 0, 5, 60]), rng.choice([0, 3, 50, 700])) for _ in range(rng.randrange(1, 9))]) for d in range(60)}
    rows = [(d, "b", 9, f"c{k}", size, w, m, p) for d, (size, cats) in draws.items() for k, (w, m, p) in enumerate(cats)]
    df = spark.createDataFrame(rows, "draw_id bigint, build string, max_rank int, cat string, size bigint, weight bigint, least bigint, pool bigint")
    got = {}
    for r in sampling.solve(df).collect():
        got.setdefault(r["draw_id"], {})[r["cat"]] = r["quota"]
    for d, (size, cats) in draws.items():
        want, mine = brute_quotas(size, cats), [got[d][f"c{k}"] for k in range(len(cats))]
        assert all(abs(q - w) < 1 + 1e-6 for q, w in zip(mine, want))
        feasible = sum(p if w else min(m, p) for w, m, p in cats)
        assert sum(mine) == max(sum(min(m, p) for _, m, p in cats), min(size, feasible))


def test_reservoirs_keep_the_least_whatever_the_batches(spark):
    import pandas as pd

    rng = np.random.default_rng(4)
    whole = pd.DataFrame({"draw_id": 1, "build": "b", "max_rank": 9, "cat": rng.choice(["x", "y"], 60_000), "iri": [f"i{k}" for k in range(60_000)], "rank": 1, "prio": rng.permutation(60_000), "need": 70})
    out = pd.concat(sampling._reservoirs(iter([whole[k : k + 7_000] for k in range(0, 60_000, 7_000)])))
    for cat in "xy":
        mine = out[out["cat"] == cat]
        assert sorted(mine["prio"].dropna()) == sorted(whole[whole["cat"] == cat]["prio"])[:70] and mine["n"].sum() == (whole["cat"] == cat).sum()


# ---------------------------------------------------------------- p6


def test_fusion_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for b, n in (("x", 150), ("y", 7), (None, 3)):
        for k in range(n):
            rows.append((b, f"i{k}", "c", k, rng.choice([None, float("nan"), rng.gauss(0, 1), 5.0, -9.0 - rng.random(), -800.0 - rng.random(), 1e4]), rng.choice([None, int(rng.paretovariate(0.5))]), rng.choice([1, 2, 3, 40]), "1", "x", 0))
    df = spark.createDataFrame(rows + rows[:20], RANKED)
    got = {(r["build"], r["iri"]): r for r in fusion.with_places(fusion.fuse(df)).collect()}
    assert len(got) == len(rows)
    low = -math.inf
    clean = lambda v: low if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)
    for b in ("x", "y", None):
        mine = [r for r in rows if r[0] == b]
        cols = {"views": [clean(r[5]) for r in mine], "languages": [clean(r[6]) for r in mine], "score": [clean(r[4]) for r in mine]}
        part = {}
        for name, vs in cols.items():
            x = [math.copysign(math.log1p(abs(v)), v) if name != "score" and v != low else v for v in vs]
            known = [v for v in x if v != low]
            med = float(np.median(known)) if known else 0.0
            mad = float(np.median(np.abs(np.array(known) - med))) if known else 0.0
            spread = 1.4826 * mad if mad > 0 else 1.0
            logs = [-np.logaddexp(0.0, -(v - med) / spread) if v != low else None for v in x]
            least = min((v for v in logs if v is not None), default=0.0) - math.log(2)
            part[name] = [least if v is None else v for v in logs]
            assert all((p == least) == (v == low) for p, v in zip(part[name], vs))
        fused = [0.4 * v + 0.3 * lang + 0.3 * s for v, lang, s in zip(part["views"], part["languages"], part["score"])]
        for k, r in enumerate(mine):
            g = got[(b, r[1])]
            assert g["log_fused"] == pytest.approx(fused[k], rel=1e-9)
            assert g["leads"] == all(sum(o > vs[k] for o in vs) < len(mine) / 50 for vs in cols.values())
            assert g["place"] == 1 + sum(o > fused[k] + 1e-9 * abs(fused[k]) for o in fused)
    assert fusion.with_places(fusion.fuse(spark.createDataFrame([], RANKED))).count() == 0


def test_order_statistics_whose_bracket_misses(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), rng.choice([None, 1.0, rng.random(), -math.inf])) for _ in range(3000)]
    monkeypatch.setattr(fusion, "SLACK", 0.0)
    monkeypatch.setattr(fusion, "ACCURACY", 3)
    got = fusion.order_statistics(spark.createDataFrame(rows, "g string, v double"), "g", [fusion.Ask("a", F.col("v"), 0.2, fusion.middle), fusion.Ask("b", F.col("v"), 0.5, lambda c: (c, c))])
    for r in got.collect():
        known = sorted(v for g, v in rows if g == r["g"] and v is not None)
        n = len(known)
        assert (r["a_low"], r["a_high"], r["b_low"]) == (known[(n + 1) // 2 - 1], known[(n + 2) // 2 - 1], known[-1])


# ---------------------------------------------------------------- p3


def noisy(rng, base, cosine):
    o = rng.standard_normal(64)
    o -= (o @ base) * base
    return cosine * base + math.sqrt(1 - cosine**2) * o / np.linalg.norm(o)


def test_similar_pairs_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = similar.unit(rng.standard_normal((500, 64)))
    for k in range(100):
        x[k + 100] = noisy(rng, x[k], rng.uniform(0.93, 0.999))
    x = x * rng.uniform(0.01, 1e4, (500, 1))
    x[450:] = x[0]  # many copies
    data = [(i, [float(v) for v in x[i].astype("float32")]) for i in range(500)]
    odd = [(900, None), (901, [0.0] * 64), (902, [float("nan")] + [1.0] * 63), (903, [1.0] * 63), (904, [float("inf")] + [1.0] * 63), (905, [None] + [1.0] * 63)]
    rows = similar.vectors(spark.createDataFrame(data + data[:30] + odd, "id bigint, v array<float>").withColumn("cell", F.lit(1)), "id", "v")
    u = similar.unit(np.array([d[1] for d in data], dtype="float32"))
    s = u @ u.T
    want = {(a, b) for a, b in zip(*np.nonzero(s >= 0.95)) if a < b}
    assert as_set(similar.all_pairs(similar.similar_pairs(rows, 0.95))) == want
    many = similar.Cells((16, 4), 30)  # partitions with small cells find the same
    assert as_set(similar.all_pairs(similar.similar_pairs(rows, 0.95, many))) == want
    nn = similar.nearest(rows, rows.filter("id % 100 = 0"), 10, row_block=60, query_block=2)
    got = {}
    for r in nn.collect():
        got.setdefault(r["id"], {})[r["place"]] = r["neighbour"]
    for q in (0, 100, 200, 300, 400):
        order = sorted((j for j in range(500) if j != q), key=lambda j: (-s[q, j], j))
        score = {j: s[q, j] for j in range(500)}
        assert [score[got[q][k]] for k in range(1, 11)] == pytest.approx([score[j] for j in order[:10]], abs=1e-9)
    every = {}
    for r in similar.nearest(rows, rows, 5, row_block=200, query_block=70).collect():
        every.setdefault(r["id"], {})[r["place"]] = (r["neighbour"], r["cosine"])
    for q in range(500):
        order = sorted((-round(s[q, j], 9), j) for j in range(500) if j != q)[:5]
        assert [-c for c, _ in order] == pytest.approx([every[q][k][1] for k in range(1, 6)], abs=1e-6)
        assert q in {0, *range(450, 500)} or [j for _, j in order] == [every[q][k][0] for k in range(1, 6)]
    none = rows.filter("id < 0")
    assert similar.all_pairs(similar.similar_pairs(none, 0.95)).count() == 0 and similar.nearest(none, none, 3).count() == 0


def test_blocks_of_large_cells_and_bounds(spark, monkeypatch):
    rng = np.random.default_rng(6)
    a, b = similar.unit(rng.standard_normal((200, 64))), similar.unit(rng.standard_normal((300, 64)))
    dots, bound = similar.product(similar.Coded(np.arange(200), *similar.quantise(a)), similar.Coded(np.arange(300), *similar.quantise(b)))
    assert (np.abs(dots - a @ b.T) <= bound).all() and bound.max() < 0.03
    monkeypatch.setattr(similar, "BLOCK", 40)
    x = similar.unit(rng.standard_normal((150, 64)))
    x[100:] = [noisy(rng, x[i], 0.97) for i in range(50)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<float>")
    got = as_set(similar.all_pairs(similar.similar_pairs(rows, 0.95, similar.Cells((), 1))))
    assert got == {(i, i + 100) for i in range(50)}


def test_cells_meet_often_enough():
    for rows in (10_000, 250_000, 50_000_000):
        cells = similar.plan_cells(rows, 0.95)
        rng = np.random.default_rng(9)
        a = similar.unit(rng.standard_normal((3000, 64)))
        o = rng.standard_normal(a.shape)
        o = similar.unit(o - (o * a).sum(1, keepdims=True) * a)
        b = 0.95 * a + math.sqrt(1 - 0.95**2) * o
        met = np.zeros(len(a), dtype=bool)
        for r in cells.rotations():
            met |= similar.Cells.of(a, r) == similar.Cells.of(b, r)
        assert met.mean() > 0.998 and cells.tables < 30


# ---------------------------------------------------------------- p7

TEXTS = ["", None, " ", "Hello world, it's 2030.", "a\n\n  b\t\tc  　d e", "<|endoftext|> x", "naïve café é", "日本語テキスト🚢🏴󠁧󠁢", "x" * 50_000, "x" * 70_000 + " y " + "long" * 30_000, "word " * 30_000, "\U0001fae8 new \U0001fae9", "don't DON'T 'll ''s", "\r\n\r\n", "  lead and trail  ", "ⅷ²٣ mixed123abc"]


def test_encoding_and_round_trip(spark):
    enc = tokens._encoder(tokens.read_vocabulary())
    docs = spark.createDataFrame([doc(i, t) for i, t in enumerate(TEXTS)] + [doc(3, TEXTS[3]), doc(3, "other")], DOCS)
    got = tokens.encode(docs)
    ids = {}
    for r in got.collect():
        ids.setdefault(r["doc_id"], []).append(list(r["ids"]))
    for i, t in enumerate(TEXTS):
        assert enc.encode_ordinary(t or "") in ids[i] and len(ids[i]) == (2 if i == 3 else 1)
    back = {(r["doc_id"], r["text"]) for r in tokens.decode(got).collect()}
    assert back == {(i, t or "") for i, t in enumerate(TEXTS)} | {(3, "other")}
    assert tokens.encode(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- p8

ITEM = "Which waterway drains the basin below Bevi Gilopu once the locks at Hodi Sihipa were closed in 1972, and which town kept the toll books?"


def test_leaks(spark):
    rng = random.Random(4)
    filler = lambda n: " ".join("w" + str(rng.randrange(400)) for _ in range(n))
    w = ITEM.split()
    items = [(1, "s", ITEM), (2, "s", "Name the clerk of Voki."), (3, "s", ITEM), (4, "s", None), (5, "s", "?!"), (6, "s", "zebra"), (1, "s", ITEM)]
    docs = [
        doc(1, filler(33) + " " + " ".join(w[3:13]) + " " + filler(7)), doc(2, filler(12) + " " + " ".join(w[3:12]) + " x " + filler(9)), doc(3, filler(5) + " name THE clerk of\nvoki, " + filler(40)), doc(4, None), doc(5, ""),
        doc(6, "a ­ze­bra​!"), doc(7, " ".join(w[5:15]).upper().replace("O", "Ｏ")), doc(8, filler(200)), doc(9, "clerk name the of voki"), doc(10, filler(20_000) + " " + ITEM + " " + filler(5_000)),
        doc(1, "repeated row"), doc(11, " ".join(w[:9] + ["oddly"] + w[9:17] + ["oddly"] + w[17:])),
    ]
    got = leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, suite string, text string")).collect()
    verbatim = {(r["doc_id"], r["item_id"]) for r in got if r["kind"] == "verbatim"}
    assert verbatim == {(1, 1), (1, 3), (3, 2), (6, 6), (7, 1), (7, 3), (10, 1), (10, 3)}
    assert (11, 1) in {(r["doc_id"], r["item_id"]) for r in got if r["kind"] == "paraphrase"}
    none = spark.createDataFrame([], DOCS)
    assert leaks.leaks(none, spark.createDataFrame(items, "item_id bigint, suite string, text string")).count() == 0
    assert leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], "item_id bigint, suite string, text string")).count() == 0


def test_run_between_rarer_words_of_other_items(spark):
    rng = random.Random(7)
    common, rare = [f"c{k}" for k in range(60)], [f"r{k}" for k in range(600)]
    texts = [" ".join(rng.sample(common, 30)), *(" ".join(rare[k : k + 15]) for k in range(0, 600, 15)), " ".join(common[:3])]
    items = [(k, "s", t) for k, t in enumerate(texts)]
    run = texts[0].split()[7:17]
    mixed = lambda middle: " ".join([*rng.sample(rare, 15), *middle, *rng.sample(rare, 15)])
    docs = [doc(k, " ".join(rng.sample(common, 40))) for k in range(200)]
    docs += [doc(1000 + k, mixed(run)) for k in range(20)] + [doc(2000 + k, mixed([*run[5:], *run[:5]])) for k in range(20)] + [doc(3000, mixed(common[:3]))]
    got = leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, suite string, text string")).filter("kind = 'verbatim' and doc_id >= 1000").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1000 + k, 0) for k in range(20)} | {(3000, len(texts) - 1)}
    assert min(r["cosine"] for r in got) < 0.45


def test_paraphrased_passages_of_longer_items(spark):
    rng = random.Random(12)
    common = [x + y + z for x in "bdfgk" for y in "aeiou" for z in "lmnprstvxz"] + ["the", "of"]
    letters = [a + b for a in "abcdefgh" for b in "abcdefgh"]
    texts = [" ".join(f"Name{letters[i]}x{letters[k]}" if k % 7 == 3 else rng.choice(common) for k in range(60)) for i in range(40)]
    docs, want = [doc(k, " ".join(rng.choices(common, k=60))) for k in range(300)], set()
    for i, text in enumerate(texts):
        for n, at in enumerate((0, 20, 45)):
            part = text.split()[at : at + 15]
            plain = [k for k, w in enumerate(part) if not w.startswith("Name")]
            for k in sorted(rng.sample(plain, 2), reverse=True):
                del part[k]
            for k in rng.sample(range(1, 12, 3), 2):
                part.insert(k, "oddly")
            docs.append(doc(1000 + 10 * i + n, " ".join([*rng.choices(common, k=30), *part, *rng.choices(common, k=30)])))
            want.add((1000 + 10 * i + n, i))
        swapped = [w.replace(f"Name{letters[i]}x", f"Name{letters[i]}y") for w in text.split()[20:35]]  # other answers
        docs.append(doc(5000 + i, " ".join([*rng.choices(common, k=30), *swapped[:7], "oddly", *swapped[7:], *rng.choices(common, k=30)])))
    got = leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "item_id bigint, suite string, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got if r["kind"] == "paraphrase"}
    assert len(found & want) >= 0.95 * len(want) and found <= want


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 12, 40]))) for _ in range(60)]
    docs = [doc(k, " ".join([*(f"w{rng.randrange(900)}" for _ in range(40)), *texts[k % 60].split()[:12], "z"])) for k in range(150)]
    run = lambda: {tuple(r)[:3] for r in leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "item_id bigint, suite string, text string")).collect()}
    one = run()
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 300)
    monkeypatch.setattr(leaks, "TASK_TRIPLES", 200)
    assert {r for r in run() if r[2] == "verbatim"} == {r for r in one if r[2] == "verbatim"} and len(one) >= 150


def test_answers():
    plain = "Which waterway drains Bevi Gilopu after 1972? The town of Hodi kept 3 books."
    assert [plain.replace("?", "").replace(".", "").split()[a:b] for a, b in leaks.answers(plain)] == [["Bevi", "Gilopu"], ["1972"], ["Hodi"], ["3"]]


def test_words_are_runs_of_letters_and_digits():
    import unicodedata

    odd = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and bool(leaks.WORD.match(chr(c))) != (unicodedata.category(chr(c))[0] in "LN")]
    assert odd == [] and leaks.words("a_b Ⅷ٣ ½x") == ["a", "b", "viii٣", "1", "2x"]


def test_subsequence():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 9, 5, 4])
    assert leaks._common_subsequence(a, b) == 3 and leaks._common_subsequence(a, a) == 5


# ---------------------------------------------------------------- p9

PROSE = "The foundry was built of lead and slate between 1761 and 1835, and it still belongs to the parish. As a young glazier he lived with an aunt in the old quarter and sent his first poems to a paper. "
WORDS = [("en", w) for w in "a an and as at be by for from he his in is it of on or that the to was which with still first".split()] + [("fr", w) for w in "de la le et en un une".split()]
JUNK = [
    "Next page | Home | Index | Print | Edit | " * 12, "\n".join(f"{k}. Duve Menebu, slate mill;" for k in range(40)), "\n".join(f"Nova\t{k * 37}\t{k}.5\ttin" for k in range(40)), "[" + ",".join(f'{{"iri":"http://x/{k}","views":{k}}}' for k in range(40)) + "]",
    "!?" * 300, "cheap best download granite kiln vago seto cheap best " * 15, "Error 186\n" * 60, "m53bymYoiVcXuze4W9ZUS+qzcccFp/OE\n" * 20,
]


def test_quality(spark):
    texts = [PROSE * 3, PROSE.upper() * 3, (PROSE * 3).replace(",", "").replace(".", "").lower(), "\r\n".join((PROSE * 3)[k : k + 60] for k in range(0, 560, 60)), *JUNK, PROSE + "\n\n" + JUNK[1] * 3, PROSE * 8 + "\n\n" + JUNK[2], None, "", "  \n", PROSE * 1500]
    rows = [doc(i, t, None if i % 3 else "EN") for i, t in enumerate(texts)]
    common = spark.createDataFrame(WORDS, "lang string, word string")
    # the learner needs a corpus: each kind a few times under other ids
    more = [doc(1000 + 10 * i + k, t) for i, t in enumerate(texts[:-1]) if t for k in range(6)] + [doc(5000 + k, PROSE * 2) for k in range(150)]
    got = {r["doc_id"]: r for r in quality.statistics(spark.createDataFrame(rows + rows[:2] + more, DOCS), common).collect()}
    prose = {i: (r["prose_share"] is not None and r["prose_share"] >= 0.5) for i, r in got.items() if i < 100}
    n = len(JUNK)
    assert [prose[i] for i in range(4)] == [True] * 4 and not any(prose[4 + k] for k in range(n))
    assert not prose[4 + n] and prose[5 + n] and prose[len(texts) - 1]
    for i in (6 + n, 7 + n, 8 + n):
        assert got[i]["text_type"] == "empty" and got[i]["prose_share"] is None and got[i]["words"] == 0
    assert got[0]["words"] == len(PROSE.split()) * 3 and got[0]["mean_word_length"] == pytest.approx(sum(map(len, PROSE.split())) / len(PROSE.split()))
    assert got[0]["text_type"] == "prose" and {got[4 + k]["text_type"] for k in range(n)} <= set(quality.TYPES[1:])
    assert all(sum(r[f"p_{t}"] for t in quality.TYPES) == pytest.approx(1) for r in got.values() if r["words"])
    assert quality.statistics(spark.createDataFrame([], DOCS), common).count() == 0
    model = quality.fit(spark.createDataFrame(rows + more, DOCS), common)
    kept = quality.Model.from_json(model.to_json())
    alone = quality.statistics(spark.createDataFrame(rows[:12], DOCS), common, kept).collect()
    assert all(r["text_type"] == got[r["doc_id"]]["text_type"] and r["p_prose"] == pytest.approx(got[r["doc_id"]]["p_prose"], abs=0.02) for r in alone)


def test_closed_lines(spark):
    texts = ["One line.", "First one.\n\nSecond one!\n\nThird \u201cone.\u201d\n\nFourth one? ", "a,\nb;\nc\n", "x.\r\ny\u2028(z.)\n \n\n", "..."]
    got = {r["doc_id"]: r["closed_lines"] for r in quality.statistics(spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOCS), spark.createDataFrame(WORDS, "lang string, word string")).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.0, 3: pytest.approx(2 / 3), 4: 1.0}
