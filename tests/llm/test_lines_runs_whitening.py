"""Line deduplication, periodic runs and whitening against plain Python and numpy."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from compare import connect, differences

from tidemark.llm import charpoly, linededup, periodicity, queries, whitening
from tidemark.llm.runs import periodic_stretches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SMALL = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_lines(rows, least=2):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    first = {k: min(ids) for k, ids in holders.items() if len(ids) >= least}
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or first.get(key(x), i) == i]
        found.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(found, key=str)


LINES = [
    (5, "Shared line of text\nonly here, five\n  SHARED line of TEXT\t"),
    (3, " shared Line of text \n\nshort\nonly here, three"),
    (9, "short\nshared line of text\n\n\n"),
    (9, "shared line of text"),
    (9, "shared line of text"),
    (None, "shared line of text\nonly here, three"),
    (None, None),
    (7, None),
    (8, ""),
    (10, "ÄÖÜ äöü ßß\nnine code"),
    (11, "ÄÖÜ äöü ßß\nnine code\nÄÖÜ ÄÖÜ ßß"),
    (12, "\x1fshared line of text\n\xa0shared line of text"),
    (13, "x" * 200_000 + "\n" + "many lines here\n" * 5000),
    (14, "x" * 200_000 + "\nmany lines here\r"),
]


@pytest.mark.parametrize("least", [2, 3])
def test_repeated_lines(spark, least):
    rows = [(i, t, "a", 1, 2, 3) for i, t in LINES]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, h1 int, _n int, _first int").repartition(3)
    left = linededup.drop_repeated_lines(table, least)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.text)) for r in left.collect()), key=str)
    assert got == plain_lines(LINES, least)


def test_a_line_of_every_document(spark):
    rows = [(i, f"the line that all have\nline number {i} alone") for i in range(3000)]
    got = linededup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == plain_lines(rows)


def test_lines_equal_sql(spark):
    name = "op11_drop_repeated_lines"
    assert not differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name])


def plain_runs(words, least=6, times=4):
    found = set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(least, times * q):
                part = words[start:end]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((start, end - start, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_report(i, text):
    words = WORD.findall(text or "")
    if i is not None and words:
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (i, len(runs), *longest, sha(told), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


@pytest.mark.parametrize("seed", range(4))
def test_stretches_of_random_sequences(seed):
    dice, sequences = random.Random(seed), []
    for _ in range(250):
        size, letters = dice.randint(0, 70), dice.choice([1, 2, 2, 3, 5])
        one = [dice.randrange(letters) for _ in range(size)]
        if dice.random() < 0.5:
            unit = [dice.randrange(letters) for _ in range(dice.randint(1, 9))]
            one[size // 2 : size // 2] = unit * dice.randint(2, 9) + unit[: dice.randint(0, len(unit))]
        sequences.append(one)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    symbols = np.array([x for s in sequences for x in s], np.int64)
    for least, times in ((6, 4), (1, 5)):
        found = [[] for _ in sequences]
        for s, *run in zip(*periodic_stretches(symbols, starts, least, times), strict=True):
            found[s].append(tuple(int(x) for x in run))
        assert found == [plain_runs(s, least, times) for s in sequences]


def test_runs_of_odd_documents(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows += [(i, "a b " * (i % 7) + "c " * (i % 11) + "a b c d e " * (i % 5) + str(i)) for i in range(100, 400)]
    rows += [(i, " ".join(f"w{k}" for k in range(i % 60))) for i in range(400, 700)]
    rows = [(i, t) for i, t in rows if i != 9]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, _h int, runs string, start long")
    got = sorted(map(tuple, periodicity.run_report(table).collect()), key=str)
    assert got == sorted((plain_report(*r) for r in rows), key=str)
    assert {r[1] for r in got} > {0, 1, 2}


def test_runs_of_a_very_long_text(spark):
    text = "palabra " * 300_000 + "otra " + "uno dos tres " * 50_000
    found = periodicity.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(0, 300_000, 1), (300_001, 150_000, 3)]
    assert found.collapsed == "palabra otra uno dos tres"


def test_runs_of_the_test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == len(rows) and len(short) > 500
    assert [got[i] for i, _ in short] == [plain_report(i, t) for i, t in short]


@pytest.mark.parametrize("size", [1, 2, 3, 6, 9])
def test_polynomials_modulo_a_prime(size):
    dice = np.random.default_rng(size)
    matrix = dice.integers(-50, 50, (size, size))
    matrix[:, size // 2] = 0
    p = 2_147_483_629
    want = [round(x) % p for x in np.poly(matrix)[::-1]]
    assert charpoly.charpoly_mod(matrix % p, p) == want


def test_primes():
    found = charpoly.primes_below(2000, 40)
    assert found == [n for n in range(1999, 1, -1) if all(n % d for d in range(2, n))][:40]


def test_multiple_and_close_roots():
    poly = [1]
    for root in (0, 0, 3, 3, 3, 7, 10**9, 10**9 + 1):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    got = charpoly.largest_roots(poly, 5)
    assert [(round(r.value), r.times) for r in got] == [(10**9 + 1, 1), (10**9, 1), (7, 1), (3, 3)]
    assert charpoly.largest_roots([0, 0, 1], 3) == []


@pytest.mark.parametrize("case", ["plain", "equal", "flat", "close", "large"])
def test_components_of_a_matrix(spark, case):
    dice = np.random.default_rng(4)
    rows = dice.integers(-40, 40, (60, 7)).astype(object)
    if case == "equal":
        rows = np.array([[x if i == j else 0 for j in range(5)] for i in range(5) for x in (3, -3)], object)
    if case == "flat":
        rows[:, 3] = rows[:, 2]
    if case == "close":
        rows = np.array([[10**6 + (i == 0), -(10**6) - (i == 0)][s] * np.eye(4, dtype=int)[i] for i in range(4) for s in (0, 1)], object)
    if case == "large":
        rows = rows * 10**9 + 7
    sums = rows.sum(axis=0)
    scatter = [[int(x) for x in r] for r in len(rows) * (rows.T @ rows) - np.outer(sums, sums)]
    found = whitening.components_of(spark, scatter, 16)
    exact = np.array(scatter, float)
    size = np.linalg.matrix_rank(exact)
    assert len(found) == size
    values = np.array([float(e) for e, _ in found])
    assert np.allclose(values, np.linalg.eigvalsh(exact)[::-1][:size], rtol=1e-9)
    vectors = np.array([v for _, v in found]).T
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-14
    assert np.abs(exact @ vectors - vectors * values).max() < 1e-14 * values[0]


def check_whitening(rows, got):
    """``got`` against numpy, for rows (vec_id, vector) of usable vectors."""
    whole = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in whole})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(size)]
    centred = np.array([[n * x[k] - sums[k] for k in range(size)] for x in fit], float) / n
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1][:16]
    values = values[values > 1e-9 * values[0]]
    place, by_row = {x: k for k, x in enumerate(fit)}, {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(got) == len(rows) * len(values) and all(r.n == n for r in got)
    white = np.zeros((n, len(values)))
    for i, x in whole:
        deviation = sum((n * x[k] - sums[k]) ** 2 for k in range(size))
        mine = [r for r in by_row[i, deviation]]
        for r in mine:
            white[place[x], r.component - 1] = r.whitened
            assert abs(r.explained / (values[r.component - 1] / np.trace(cov)) - 1) < 1e-9
    error = np.abs(white.T @ white / n - np.eye(len(values))).max()
    assert error < 1e-9 and all(r.identity_error < 1e-9 for r in got)
    # (x - S/n) projected on the components, times sqrt(e), gives the components back
    vectors = centred.T @ white / n / np.sqrt(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-9 * values[0]


def test_whitening_of_the_test_vectors(spark):
    got = queries.QUERIES["op12_whiten_embeddings"](spark, SMALL).collect()
    check_whitening([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()], got)


def test_whitening_of_odd_vectors(spark):
    dice = np.random.default_rng(8)
    good = [(i, [float(np.float32(x)) for x in dice.normal(size=3)]) for i in range(40)]
    good += [(3, good[3][1]), (None, good[5][1]), (77, good[6][1]), (78, [-0.0, 5e3, -5e3])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 1.0, 1.0]), (94, [1.0, float("inf"), 1.0])]
    rows = [(i, v, 1, 2, 3) for i, v in good + bad]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, x int, whitened int").repartition(3)
    got = whitening.whitening_report(table).collect()
    check_whitening([(i, v) for i, v in good], got)
    assert len({(r.vec_id, r.component) for r in got}) == (len(good) - 1) * 3


def test_whitening_without_components(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitening_report(spark.createDataFrame(rows, schema)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)
    assert {r.component for r in whitening.whitening_report(line).collect()} == {1}
    for wrong in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, [3e20, 1.0])]):
        with pytest.raises(Exception, match="differ in length|too large"):
            whitening.whitening_report(spark.createDataFrame(wrong, schema).coalesce(1)).collect()


def test_empty_tables_of_documents(spark, odd_documents):
    empty = odd_documents.limit(0)
    assert linededup.line_report(empty).count() == 0
    assert periodicity.run_report(empty).count() == 0
