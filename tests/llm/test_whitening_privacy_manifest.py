"""Operators 11 to 13 against brute force, and their odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagecraft.llm import merkle, personal_data, whitening


# -- operator 11 ----------------------------------------------------------------
def whitened_by_force(vectors, k):
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors], dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ q / np.sqrt(e), e / np.trace(covariance)


def fitted(spark, vectors, k=8):
    rows = [(i, v) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    return whitening.whiten(frame, k).orderBy("vec_id", "component").toPandas()


def test_whitening_against_brute_force(spark):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(400, 12)) * np.linspace(1, 3, 12) + r.normal(size=12)).tolist()
    got = fitted(spark, vectors)
    deviation, expected, explained = whitened_by_force(vectors, 8)
    values = got.whitened.to_numpy().reshape(-1, 8)
    signs = np.sign((values * expected).sum(axis=0))
    assert np.abs(values * signs - expected).max() < 1e-9
    assert (got.deviation.to_numpy().reshape(-1, 8) == deviation[:, None]).all()
    assert np.allclose(got.explained.to_numpy()[:8], explained, rtol=1e-12)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    assert (got.n == 400).all() and got.component.tolist() == [1, 2, 3, 4, 5, 6, 7, 8] * 400


def test_whitening_of_repeated_variances(spark):
    """Equal variances: their components are any basis of their space, but none is lost."""
    vectors = [[s * 2.0 * (i == j) for j in range(6)] for i in range(6) for s in (1, -1)]
    got = fitted(spark, vectors)
    assert got.component.max() == 6 and got.identity_error.iloc[0] < 1e-10
    assert np.allclose(got.explained, 1 / 6)


def test_whitening_without_variance(spark):
    assert len(fitted(spark, [[1.0, 2.0]] * 5)) == 0
    assert len(fitted(spark, [])) == 0
    assert len(fitted(spark, [[1.0, 2.0]])) == 0
    # Two different rows have one direction.
    two = fitted(spark, [[0.0, 0.0, 0.0], [1.0, 1.0, 0.0], [1.0, 1.0, 0.0]])
    assert set(two.component) == {1} and len(two) == 3 and two.explained.iloc[0] == pytest.approx(1)


def test_whitening_leaves_out_what_it_cannot_use(spark):
    rows = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(30)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("-inf"), 0.0, 0.0])]
    rows += [(105, [1e300, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (5, rows[5][1]), (106, [4.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("n", F.lit(1)).withColumn("x", F.lit("x"))
    got = whitening.whiten(frame).toPandas()
    vectors = [v for i, v in rows[:30]] + [rows[5][1], [4.0, 0.0, 0.0]]
    deviation, _, _ = whitened_by_force(vectors, 1)
    assert sorted(got[got.component == 1].vec_id) == sorted([*range(30), 5, 106])
    assert sorted(got[got.component == 1].deviation) == sorted(deviation.tolist())
    assert (got.n == 32).all()


def test_whitening_of_large_entries(spark):
    got = fitted(spark, [[1e7, 0.0], [-1e7, 0.5], [0.0, 1.0], [1e12, 3.0]], 1)
    assert got.deviation.isna().all()  # beyond a long
    assert got.identity_error.iloc[0] < 1e-9
    exact = fitted(spark, [[4e5, 0.0], [-4e5, 0.5], [0.0, 1.0]], 1)
    deviation, _, _ = whitened_by_force([[4e5, 0.0], [-4e5, 0.5], [0.0, 1.0]], 1)
    assert exact.deviation.tolist() == deviation.tolist()


# -- operator 12 ----------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def found(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("id", F.lit(2))
    rows = personal_data.find_personal_data(frame.repartition(2)).orderBy("doc_id").collect()
    return [[(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]] for r in rows]


def check_number(digits):
    """Digits with the one that makes Luhn's sum right."""
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def test_base_spans_against_brute_force(spark):
    r = random.Random(7)
    parts = ["a@b.co", "@", ".", "x", "_", "%", "-", " ", "ü", "\U0001f600", "1", "12", "255", "256", "007", "10.0.0.1", "1.2.3", "+", "+49", "(30)"]
    parts += ["+1 (386) 555-3733", "4041 8949 7460 8795", check_number("414189497460879"), "4111-1111-1111-1111", "\n", "c@d-e.f", "\x1f"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(500)] + [None, "", " ", "a@b.c_d@e.f", "a@b.c.d@e.f.g@h", "1.1.1.1.1.1.1.1.1"]
    for text, spans in zip(texts, found(spark, texts)):
        assert [s[:3] for s in spans if s[3]] == base_spans(text), text


def test_long_texts_take_time_in_proportion(spark):
    """Runs that a pattern could be tried at from each character, and very many spans in one text."""
    n = 200_000
    texts = ["a" * n, "1" * n, "a." * n, "a@" * n, "a@b" + ".c" * n, "+1" + " " * n, "1." * n, "0" * n + ".1.1.1", "a@b.c 10.0.0.1 " * 20_000]
    got = found(spark, texts)
    assert [len(x) for x in got[:7]] == [0, 0, 0, 0, 1, 0, n // 4]
    assert got[4][0][:3] == ("email", 0, 3 + 2 * n) and got[7][0][:3] == ("ip", 0, n + 6)
    assert len(got[8]) == 40_000 and got[8][39_999][:3] == ("ip", 15 * 19_999 + 6, 15 * 19_999 + 14)


def test_added_spans(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00.", "Konto GB29NWBK60161331926819, bitte", "DE88370400440532013000", "xDE89370400440532013000",
        "please call 555-010-1234 today", "nothing near 555-010-1234 here", "Teléfono: (555) 010-1234", "tel +1 (386) 555-3733",
        "My SSN: 123-45-6789", "code 123-45-6789", "ssn 000-12-3456", "order 555-010-1234 by phone",
    ]
    got = [[s[0] for s in x if not s[3]] for x in found(spark, texts)]
    assert got == [["iban"], ["iban"], [], [], ["local_phone"], [], ["local_phone"], [], ["ssn"], [], [], []]


def test_redaction(spark):
    texts = ["write to a@b.co or +1 (386) 555-3733", "IBAN DE89370400440532013000 at 10.0.0.1, 10.0.0.256", None, "", "call 555-010-1234!"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("email gaps of text", F.lit(1))
    got = personal_data.redact(frame).orderBy("doc_id")
    assert sorted(got.columns) == ["doc_id", "email gaps of text", "text"]
    shown = [r["text"] for r in got.collect()]
    assert shown == ["write to [EMAIL] or [PHONE]", "IBAN [IBAN] at [IP], 10.0.0.256", None, "", "call [LOCAL_PHONE]!"]


def test_personal_data_runs_no_python(spark):
    frame = spark.createDataFrame([(1, "a@b.c")], "doc_id bigint, text string")
    plan = personal_data.find_personal_data(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert personal_data.find_personal_data(frame.limit(0)).count() == 0


# -- operator 13 ----------------------------------------------------------------
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, at):
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def manifest_by_force(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in langs}
    trees = {g: tree_of([leaf_of(r) for r in groups[g]]) for g in langs}
    top = tree_of([trees[g][-1][0] for g in langs])
    out = []
    for number, g in enumerate(langs):
        for at, row in enumerate(groups[g]):
            path = [*siblings(trees[g], at), *siblings(top, number)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            d = leaf_of(row, changed)
            for before, after in path:
                d = h(*before, d, *after)
            proof = h(*(x for before, after in path for x in (*before, *after)))
            out.append((row[0], leaf_of(row), trees[g][-1][0], top[-1][0], proof, d, d == top[-1][0]))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def manifest(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("tree", "pos", "of", "d", "id", "group", "path", "other"):
        frame = frame.withColumn(name, F.lit(name))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", UPPER, UPPER.lower()))
    return [tuple(r) for r in merkle.merkle_manifest(frame, changed={"text": tampered}).select(*COLUMNS).collect()]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 150])
def test_manifest_against_brute_force(spark, n):
    """A language with most rows, one with a single row, none, many languages, repeated rows and ids."""
    r = random.Random(n)
    langs = ["en"] * 12 + [None, "de", "zz", "Ä", "EN", *(f"l{i}" for i in range(8))]
    rows = [(i, r.choice(["web", None, ""]), r.choice(langs), r.choice([None, i * 7]), r.choice([None, "", "Ab Cé", "xyz", "Ü" * 300, "lower only"])) for i in range(n)]
    if n > 9:
        rows += rows[:5] + [(None, "web", "en", 1, "No Id"), (None, "web", "en", 1, "No Id"), (3, "other", rows[3][2], 2, "Same id"), (500, "a", "one", 1, "T")]
    key = lambda x: tuple(map(repr, x))
    got, expected = manifest(spark, rows), manifest_by_force(rows)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_manifest_of_an_empty_table(spark):
    assert manifest(spark, []) == []


def test_manifest_without_changes_verifies_everywhere(spark):
    rows = [(i, "s", "en", 1, "T" * i) for i in range(20)]
    got = merkle.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 20 and all(r["verified"] for r in got)
    assert {len(r["path"]) for r in got} == {2}
