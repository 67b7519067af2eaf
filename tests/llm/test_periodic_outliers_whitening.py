"""Periodic runs, robust outliers and whitening against plain versions, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import eigen, lyndon, outliers, periodic, queries, text, whitening
from millrace.llm.workspace import beside

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UNSPACED = re.compile(r"[^\x20\x09-\x0D]+")


def sample(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(*[c.to_pylist() for c in table.columns], strict=True))


@pytest.fixture(scope="module")
def awkward(spark):
    made = random.Random(4)
    pool = ["".join(made.choice("abcdefghij") for _ in range(made.randint(2, 9))) for _ in range(300)]
    some = lambda n: " ".join(made.choice(pool) for _ in range(n))
    rows = [(i, some(60), "en", f"s{i % 3}", i) for i in range(40)]
    rows += [(50, None, "en", "s0", 1), (51, "", None, None, 0), (None, some(50), None, None, 1), (52, " \n\t ", "de", "s1", 3), rows[3], rows[3]]
    rows += [(53, "ab " * 40000, "en", "s1", 1), (54, some(90000), "en", "s1", 1), (55, some(9), "ja", None, 1), (56, "x　y ä ö " * 9, "de", "s1", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# 11


def plain_lyndon(w):
    def is_lyndon(x):
        return all(x < x[k:] for k in range(1, len(x)))

    return [max(j - i for j in range(i + 1, len(w) + 1) if is_lyndon(w[i:j])) for i in range(len(w))]


def plain_runs(w, least=12):
    x, found = np.unique(np.array(w, dtype=object).astype(str), return_inverse=True)[1] if w else np.zeros(0), []
    for q in range(1, len(w) // 2 + 1):
        edges = np.diff(np.concatenate(([0], (x[:-q] == x[q:]).astype(int), [0])))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if e - s + q >= max(least, 2 * q) and not any(f[:2] == (s, e - s + q) and q % f[2] == 0 for f in found):
                found.append((s, e - s + q, q))
    return sorted(found)


def test_lyndon_arrays_and_runs():
    made = random.Random(1)
    for _ in range(400):
        w = [made.randrange(made.choice([1, 2, 3, 5])) for _ in range(made.randint(1, 22))]
        assert lyndon.lyndon_array(w) == plain_lyndon(w)
        for least in (2, 12):
            assert lyndon.runs(np.array(w), least) == plain_runs(w, least)
    for w in ([1] * 3000, list(range(3000)), list(range(3000, 0, -1)), [0, 1, 1] * 900 + [5] + [0, 1, 1] * 30):
        assert lyndon.runs(np.array(w), 12) == plain_runs(w)


def test_unequal_stretches_with_equal_sums_are_no_run(monkeypatch):
    w = np.array([made for made in random.Random(3).choices(range(4), k=300)] + [1, 2, 3] * 20)
    monkeypatch.setattr(lyndon.Extensions, "same", lambda self, a, b, size: np.ones(len(a), dtype=bool))
    assert set(lyndon.runs(w, 12)) <= set(plain_runs(w.tolist()))
    assert max(plain_runs(w.tolist()), key=lambda r: r[1]) in lyndon.runs(w, 12)


def plain_digest(words):
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def planted(doc_id, value):
    w, h = UNSPACED.findall(value or ""), zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def test_periodic_query_equals_a_plain_search(spark, sf_dir):
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    texts = sample(sf_dir)
    assert len(found) == len(texts)
    for doc_id, value in texts:
        assert found[doc_id] == plain_digest(planted(doc_id, value)), doc_id


def test_periodic_runs_of_awkward_rows(awkward, empty):
    rows = periodic.periodic_runs(awkward.withColumns({"runs": F.lit("clash"), "Text_": F.lit(1)})).collect()
    assert len(rows) == awkward.count() and {"Text_", "lang", "runs", "collapsed"} <= set(rows[0].asDict())
    given = {r["n_chars"]: r for r in awkward.collect()}
    by = {r["doc_id"]: r for r in rows}
    for doc_id in (50, 51, 52):
        assert by[doc_id]["runs"] == [] and by[doc_id]["collapsed"] == ""
    assert [tuple(r) for r in by[53]["runs"]] == [(0, 40000, 1)] and by[53]["collapsed"] == "ab"
    assert by[54]["runs"] == [] and len(by[54]["collapsed"].split(" ")) == 90000
    assert [tuple(r) for r in by[56]["runs"]] == [(0, 18, 2)] and by[56]["collapsed"] == "x　y ä ö"
    assert by[None]["collapsed"] and given
    assert periodic.digests(periodic.periodic_runs(periodic.with_periods(empty))).collect() == []
    assert periodic.digests(periodic.periodic_runs(periodic.with_periods(awkward))).count() == awkward.count()


def test_stretches_keep_every_run():
    made = random.Random(8)
    reader = text.WordReader(np.arange(256, dtype=np.uint8), text.unspaced())
    for _ in range(60):
        w = [str(made.randrange(6)) for _ in range(made.randint(0, 60))]
        w = w + (w[: made.randint(1, 9)] * 9)[: made.randint(0, 40)] + ["z"] + w
        words = reader.read(__import__("pyarrow").array([" ".join(w)]))
        inside = {i for a, b in periodic.stretches(words).tolist() for i in range(a, b)}
        assert all(set(range(s, s + n)) <= inside for s, n, _ in plain_runs(w))


# 12


def plain_statistics(value):
    w = UNSPACED.findall(value or "")
    lines = [x for x in (value or "").split("\n") if UNSPACED.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), sum(map((value or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(repeated)


@pytest.fixture(scope="module")
def verdicts(spark, sf_dir):
    return queries.op12_outliers(spark, sf_dir).cache()


def test_statistics_equal_a_plain_count(verdicts, sf_dir):
    rows = verdicts.collect()
    texts = dict(sample(sf_dir))
    assert len(rows) == len(texts)
    for r in rows:
        plain = plain_statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain
        assert r["base_failed"] == (plain[0] < 20 or 100 * plain[4] > 30 * plain[0])
        assert not (r["base_failed"] and r["kept"])


def test_clean_documents_are_kept(verdicts, spark, sf_dir):
    found = verdicts.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("not base_failed")
    share = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.98 and share[0] <= 0.2


def test_quantiles_and_consistency():
    draws = np.random.default_rng(2).standard_normal((200_000, outliers.P))
    d = (draws**2).sum(axis=1)
    for q in (0.5, 0.75, 0.975):
        assert abs(np.mean(d <= outliers.quantile(q, outliers.P)) - q) < 0.005
    core = draws[d <= np.quantile(d, outliers.CORE)]
    assert abs(outliers.consistency(outliers.CORE) * core[:, 0].var() - 1) < 0.02


def vectors_of(spark, groups):
    rows = [(lang, source, *map(float, t)) for (lang, source), points in groups.items() for t in points]
    return spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"t{i} double" for i in range(outliers.P)))


def plain_estimate(points):
    """Concentration from the best of many random starts, consistency, one reweighting; no prior."""
    floors, best = np.diag(np.square(outliers.FLOORS)), None
    h = math.ceil(outliers.CORE * len(points))
    chance = np.random.default_rng(0)
    for _ in range(60):
        core = points[chance.choice(len(points), outliers.P + 2, replace=False)]
        for _ in range(30):
            m, c = core.mean(axis=0), np.cov(core.T, bias=True) * outliers.consistency(outliers.CORE) + floors
            d = np.einsum("ij,jk,ik->i", points - m, np.linalg.inv(c), points - m)
            core = points[np.argsort(d)[:h]]
        if best is None or np.linalg.slogdet(c)[1] < best[0]:
            best = np.linalg.slogdet(c)[1], d
    near = points[best[1] <= outliers.quantile(1 - outliers.REWEIGHT, outliers.P)]
    return near.mean(axis=0), np.cov(near.T, bias=True) * outliers.consistency(1 - outliers.REWEIGHT) + floors


@pytest.mark.parametrize("small", [True, False])
def test_estimates_withstand_a_fifth_of_outliers(spark, small, monkeypatch):
    monkeypatch.setattr(outliers, "PRIOR", 0.0)
    chance = np.random.default_rng(7)
    spread = np.linalg.cholesky(np.diag([1.0, 4.0, 2.0, 9.0]) + 0.8)
    groups = {}
    for key, shift in {("en", "a"): 0.0, ("en", None): 5.0, (None, "b"): -3.0}.items():
        points = chance.standard_normal((1500, outliers.P)) @ spread.T + shift
        points[:300] = shift + 30 + chance.standard_normal((300, outliers.P))
        groups[key] = points
    found = {(r["lang"], r["source"]): r for r in outliers.estimates(vectors_of(spark, groups), small).collect()}
    assert set(found) == set(groups)
    for key, points in groups.items():
        mean, covariance = plain_estimate(points)
        got = np.array([found[key][f"m{i}"] for i in range(outliers.P)])
        turned = np.zeros((outliers.P, outliers.P))
        for i, j in outliers.PAIRS:
            turned[i, j] = found[key][f"w{i}{j}"]
        assert np.allclose(got, mean, atol=0.02)
        assert np.allclose(np.linalg.inv(turned.T @ turned), covariance, rtol=0.03, atol=0.05)


def test_outliers_of_awkward_rows(awkward, empty):
    rows = outliers.judged(awkward.withColumns({"kept": F.lit("clash"), "n_words": F.lit(-1), "t0": F.lit(2)})).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: r for r in rows}
    for doc_id in (50, 51, 52, 53, 55):
        assert by[doc_id]["base_failed"] and not by[doc_id]["kept"]
    assert by[54]["n_words"] == 90000 and not by[54]["base_failed"]
    assert by[1]["kept"] and by[None]["n_words"] == 50
    assert by[56]["word_chars"] == 54
    assert outliers.judged(empty).collect() == []
    assert outliers.judged(awkward.where("doc_id < 30"), broadcast_groups=0).where("kept").count() == 32


def test_salted_join_keeps_null_groups(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(200)], "n int, g string")
    models = spark.createDataFrame([("a", 1), (None, 2)], "g string, m int")
    for small in (True, False):
        found = beside(rows, models, ["g"], small)
        assert found.columns == ["n", "g", "m"]
        assert sorted(r["m"] for r in found.collect()) == [1] * 100 + [2] * 100


# 13


@pytest.mark.parametrize("kind", ["random", "equal", "cluster", "split"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_eigenpairs(kind, n):
    chance = np.random.default_rng(n)
    a = chance.standard_normal((n, 2 * n))
    turn = np.linalg.qr(a)[0]
    m = {
        "random": a @ a.T, "equal": 3 * np.eye(n), "split": np.diag(np.arange(n) // 2 + 1.0),
        "cluster": turn @ np.diag(1 + np.linspace(0, 1e-9, n)) @ turn.T,
    }[kind]
    m = (m + m.T) / 2
    values, vectors = eigen.leading(m, 4)
    assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:4], rtol=1e-12, atol=1e-13)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(m @ vectors.T - vectors.T * values).max() < 1e-12 * max(1, np.abs(m).max())


def plain_whitening(rows):
    x = [[math.floor(256 * float(c)) for c in v] for _, v in rows]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    y = fit.astype(float) - mean
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors.T[::-1][:4]
    out = {}
    for (vec_id, _), row in zip(rows, x, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        out[vec_id] = (n, deviation, (np.array(row, dtype=float) - mean) @ vectors.T / np.sqrt(values), values / np.trace(v))
    return out


def test_whitening_query_equals_a_plain_one(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/embeddings.parquet")
    given = [(i, v) for i, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    plain = plain_whitening(given)
    rows = queries.op13_whitening(spark, sf_dir).collect()
    assert len(rows) == 4 * len(given) and len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    signs = {}
    for r in rows:
        n, deviation, u, explained = plain[r["vec_id"]]
        c = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        sign = signs.setdefault(c, np.sign(r["whitened"] * u[c]))
        assert abs(sign * r["whitened"] - u[c]) < 1e-8 and abs(r["explained"] / explained[c] - 1) < 1e-9


VECTORS = "vec_id long, embedding array<float>, n string, label int"


def test_whitening_of_awkward_rows(spark):
    chance = np.random.default_rng(5)
    good = [(i, chance.standard_normal(6).tolist()) for i in range(40)]
    rows = good + [(40, None), (41, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (42, [float("nan")] * 6), (43, [float("inf")] * 6), (None, good[0][1]), (1, good[1][1])]
    rows += [(50, [0.5, 0.25]), (51, [0.5, 0.25]), (60, [1.0]), (61, [2.0]), (62, [4.0]), (70, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)
    found = whitening.whitened(df).collect()
    assert found[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    by = Counter(r["vec_id"] for r in found)
    assert by[1] == 8 and by[None] == 4 and all(by[i] == 4 for i in range(2, 40)) and not {40, 41, 42, 43, 70} & set(by)
    assert {r["n"] for r in found if r["vec_id"] in range(40)} == {40}
    same = [r for r in found if r["vec_id"] in (50, 51)]
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in same)
    single = [r for r in found if r["vec_id"] in (60, 61, 62)]
    assert len(single) == 3 and all(r["component"] == 1 and r["explained"] == 1.0 and r["identity_error"] < 1e-9 for r in single)
    plain = plain_whitening([(i, np.float32(v).tolist()) for i, v in good])
    for r in found:
        if r["vec_id"] in plain:
            assert r["deviation"] == plain[r["vec_id"]][1]
            assert abs(abs(r["whitened"]) - abs(plain[r["vec_id"]][2][r["component"] - 1])) < 1e-8
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whitened(df.where("vec_id = 40")).collect() == []


def test_whitening_far_from_zero_and_huge(spark):
    chance = np.random.default_rng(6)
    far = [(i, (1e6 + chance.integers(-9, 9, 5) / 256).tolist()) for i in range(50)]
    plain = plain_whitening(far)
    for r in whitening.whitened(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect():
        n, deviation, u, explained = plain[r["vec_id"]]
        assert r["deviation"] == deviation and abs(abs(r["whitened"]) - abs(u[r["component"] - 1])) < 1e-6
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [1e15, 3.0])], "vec_id long, embedding array<double>")
    assert all(r["deviation"] is None and r["n"] == 3 for r in whitening.whitened(huge).collect())


def test_lengths_are_fitted_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MODEL_CELLS", 20)
    chance = np.random.default_rng(9)
    rows = [(i, chance.standard_normal(2 + i % 4).tolist()) for i in range(60)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter(r["vec_id"] for r in found) == {i: min(4, 2 + i % 4) for i in range(60)}


# shared


def test_words_that_repeat_themselves_have_hashes_of_their_own():
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    reader = text.WordReader(text.lowering(), text.unspaced())
    long = "x" * (text.SEGMENT + 5)
    read = reader.read(__import__("pyarrow").array([f"{word} {other} {word}", long, long + "y", f" {long} {word}"]))
    h = read.hashes.tolist()
    assert h[0] != h[1] and h[0] == h[2] == h[6] and h[3] == h[5] != h[4]
