"""Operators on texts: brute force, exact round trips, held-out accuracy, and odd inputs."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from stagecraft.llm import common, compression, decontaminate, language_id, line_dedup, lm_scoring, near_dedup, quality
from stagecraft.llm import sentencepiece_fst as sp_fst
from stagecraft.llm import token_output, url_filter

P = pytest.importorskip("public_tokenizers")
LONG = " ".join(f"w{i}" for i in range(30_000))
A_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# id, text: null and empty texts, a null id, white space alone, repeated rows, ties, a very long text.
ODD = [
    (1, None),
    (2, ""),
    (None, "a row without an id has text"),
    (3, " \n\t "),
    (4, "one two three four five six seven eight nine ten"),
    (4, "one two three four five six seven eight nine ten"),
    (5, "ONE two three four five six seven eight nine ten"),
    (6, "short"),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "Ünï cödé 日本語 \u2581 <|endoftext|> x\r\ny  z "),
]


def odd_documents(spark, rows=ODD):
    """The rows with columns that clash with names the operators make."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    clashes = ["row", "node", "u", "v", "bucket", "score", "n", "kept", "a", "b", "gone_id", "key", "line", "maybe", "removed"]
    return frame.select("*", *[F.lit(f"<{c}>").alias(c) for c in clashes])


def words(text):
    return re.findall(common.WORD_PATTERN, (text or "").translate(A_Z))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def texts_of(spark, sf):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# -- shared helpers ----------------------------------------------------------
def test_word_and_shingle_hashes_agree_with_words():
    import pyarrow as pa

    texts = [t for _, t in ODD if t != LONG]
    data, offsets = common.utf8_buffers(pa.array(texts))
    hashes, at, starts, ends = common.word_hashes(data, offsets)
    found = [[bytes(data[a:b]).decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(at[:-1], at[1:])]
    assert [[w.translate(A_Z) for w in f] for f in found] == [words(t) for t in texts]
    for k in (1, 3, 5):
        values, to = common.shingle_hashes(hashes, at, k)
        sizes = [len(set(values[x:y].tolist())) for x, y in zip(to[:-1], to[1:])]
        assert sizes == [len(shingles(t, k)) for t in texts]


# -- 2: line dedup -----------------------------------------------------------
def removed_by_force(rows):
    lines, gone = [], set()
    order = lambda r: (r[0] is not None, r[0] or 0)
    for at, (_, text) in enumerate(sorted(rows, key=order)):
        for no, line in enumerate((text or "").split("\n")):
            w = [x for x in line.split(" ") if x]
            if w:
                lines.append(((at, no), {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}))
    for i, (at, s) in enumerate(lines):
        if any(9 * len(s & t) >= 4 * (len(s) + len(t)) for _, t in lines[:i]):
            gone.add(at)
    return sorted(rows, key=order), gone


def kept_text(at, text, gone):
    return None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if (at, no) not in gone)


def test_line_dedup_against_brute_force(spark):
    r = random.Random(3)
    pool = [" ".join(r.choice("abcdefghij") * r.randint(1, 3) for _ in range(r.randint(1, 60))) for _ in range(60)]
    rows = []
    for i in range(120):
        lines = [r.choice(pool) for _ in range(r.randint(0, 5))]
        lines = [x + r.choice(["", " end", "  z", ""]) if r.random() < 0.5 else x for x in lines]
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ordered, gone = removed_by_force(rows)
    expected = {i: kept_text(at, t, gone) for at, (i, t) in enumerate(ordered)}
    assert {x["doc_id"]: x["text"] for x in line_dedup.deduplicate_lines(docs).collect()} == expected


def test_line_dedup_leaves_no_shuffle_files_of_its_steps(spark):
    rows = [(i, f"{LONG[: 60 + 7 * (i % 9)]}\nown line {i} of this text") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {m for m in re.findall(r"shuffle_(\d+)_", disk.getAllFiles().mkString(" "))}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(name, None)
    scratch = common.Scratch(spark)
    with common.shuffles_dropped(spark):
        assert line_dedup.removed_lines(docs, scratch).count() > 0
    assert not shuffles() - before
    line_dedup.deduplicate_lines(docs)
    assert len(shuffles() - before) <= 4  # of the result's own filter
    assert spark.conf.get(name, None) == was


def test_line_dedup_odd_inputs(spark):
    rows = [x for i, x in enumerate(ODD) if i != 5]
    docs = odd_documents(spark, rows)
    out = line_dedup.deduplicate_lines(docs)
    assert out.columns == [*docs.columns, "removed_lines"]
    ordered, gone = removed_by_force(rows)
    expected = sorted((repr(i), repr(kept_text(at, t, gone))) for at, (i, t) in enumerate(ordered))
    assert sorted((repr(x["doc_id"]), repr(x["text"])) for x in out.collect()) == expected
    # Rows of one id and text keep the same lines.
    both = line_dedup.deduplicate_lines(odd_documents(spark, ODD[4:6])).collect()
    assert [x["removed_lines"] for x in both] == [0, 0]
    assert line_dedup.deduplicate_lines(docs.limit(0)).count() == 0


def test_line_dedup_drops_prefixes_before_it_writes_sets(spark):
    rows = [(i, f"{LONG[: 60 + 7 * (i % 9)]}\nown line {i} of this text") for i in range(60)]
    alive = []

    class Seen(common.Scratch):
        def written(self, df, name):
            if name == "line-sets":
                alive.extend((x, spark.read.parquet(path).columns) for x, path in self._paths.items())
            return super().written(df, name)

    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert line_dedup.removed_lines(docs, Seen(spark)).count() > 0
    assert alive and not [name for name, columns in alive if "prefix" in columns]


def test_line_dedup_hashes_the_words_of_a_line_once(spark):
    lines = line_dedup.lines_of(spark.createDataFrame([(1, "a  b\n \n c")], "doc_id bigint, text string"))
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(lambda") == 1
    assert [(x["line_no"], len(x["h"])) for x in lines.orderBy("line_no").collect()] == [(0, 2), (2, 1)]


def test_line_dedup_orders_only_lines_that_may_match(spark, monkeypatch):
    counted, rarity_table = [], line_dedup.rarity_table
    monkeypatch.setattr(line_dedup, "rarity_table", lambda lines: counted.append(lines.count()) or rarity_table(lines))
    long = " ".join("abcdefghijklmnopqrst")
    rows = [(i, f"own line {i} of this text") for i in range(60)] + [(60, long), (61, f"{long} end")]
    out = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert counted == [2]
    assert [x["doc_id"] for x in out if x["removed_lines"]] == [61]


def test_line_dedup_counts_all_tokens_that_prefixes_share(spark):
    # 20 and 20 tokens, 19 common ones needed: prefixes share places 2 to 5, or only 4 and 5.
    found = {}
    for name, lost in (("near", 1), ("far", 3)):
        mine = [(k, 2, 20, k + 1) for k in range(5)]
        theirs = [(k if k >= lost else 100 + k, 1, 20, k + 1) for k in range(5)]
        rows = spark.createDataFrame(mine + theirs, "key bigint, line int, n int, place int")
        found[name] = [tuple(x) for x in line_dedup._candidates(rows, rows, whole=True).collect()]
        assert line_dedup._candidates(rows, rows, whole=False).count() == 1 - (lost > 2)
    assert found == {"near": [(2, 1)], "far": []}


def test_line_dedup_pairs_few_lines_that_share_a_passage(spark, monkeypatch):
    # 8 tokens each; those of one head or one tail share 7 (9 * 7 < 4 * 16), all others 6.
    pairs, _candidates = [], line_dedup._candidates

    def counted(*args, **kwargs):
        pairs.append((found := _candidates(*args, **kwargs)).count())
        return found

    monkeypatch.setattr(line_dedup, "_candidates", counted)
    passage, long = " ".join("abcdefghij"), " ".join(f"w{i}" for i in range(30))
    texts = [f"head{i // 16} {passage} tail{i % 16}" for i in range(256)] + [long, f"{long[:-3]}other"]
    out = line_dedup.deduplicate_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert [x["doc_id"] for x in out if x["removed_lines"]] == [257]
    assert 1 <= sum(pairs) < 256


def test_line_dedup_sketches_allow_similar_sets(spark):
    r, rows = random.Random(5), []
    for _ in range(400):
        n = r.choice([1, 2, 5, 9, 10, 40, 300, 2000])
        mine = r.sample(range(-(1 << 63), 1 << 63, 1 << 40), n)
        theirs = mine[: n - r.randint(0, n // 5)] + [r.getrandbits(62) for _ in range(r.randint(0, n // 6))]
        rows.append((mine, theirs))
    both = spark.createDataFrame(rows, "mine array<bigint>, theirs array<bigint>")
    sketch = {name: f"other_{name}" for name in line_dedup.SKETCH}
    both = both.withColumns(line_dedup.sketch_of("mine") | {sketch[k]: c for k, c in line_dedup.sketch_of("theirs").items()})
    n, m = F.size("mine"), F.size("theirs")
    like = line_dedup.similar(F.size(F.array_intersect("mine", "theirs")), n, m)
    found = both.select(like.alias("like"), line_dedup.may_be_similar(sketch, n, m).alias("may")).collect()
    assert sum(x["like"] for x in found) > 200
    assert all(x["may"] for x in found if x["like"])


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.line_dedup_query(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- 3: token files ----------------------------------------------------------
def test_packing_round_trip():
    r = np.random.default_rng(0)
    for bits in (1, 5, 8, 13, 16, 17, 32):
        ids = r.integers(0, 1 << bits, 5001).astype(np.uint32)
        shard = token_output.Shard(token_output.shard_bytes([None, 7], np.array([1, 5000]), ids, bits, block=600))
        assert (shard.read_ids(0, 5001) == ids).all() and (shard.read_ids(599, 1203) == ids[599:1203]).all()
        assert shard.null.tolist() == [True, False] and shard.read_ids(9, 9).size == 0


def test_token_files_against_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [(i, t) for i, t in texts_of(spark, SF_SMALL).items()]
    texts += [(i and 10_000 + i, t) for i, t in ODD]
    extra = ["a  b", "a \n b", "a ", " lead", "x\n\n y", "'s ''t", " ", "\n", "a\xa0b \xa0c", "\x1c a"]
    texts += [(20_000 + i, t) for i, t in enumerate(extra)]
    docs = odd_documents(spark, texts)
    manifest = token_output.write_tokens(docs, path, f"file://{tmp_path}/t", end_id=0)
    got = token_output.token_table(spark, f"file://{tmp_path}/t", manifest).collect()
    ids = {}
    for i, t in texts:
        ids.setdefault(i, []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4"))
    assert len(got) == len(texts)
    ordered = sorted(got, key=lambda x: x["start"])
    assert [x["doc_id"] for x in ordered] == sorted([i for i, _ in texts], key=lambda i: (i is not None, i or 0))
    start = 0
    for x in ordered:
        assert x["start"] == start
        assert (x["n_tokens"], x["ids_crc32"]) in [(len(y), zlib.crc32(y.tobytes())) for y in ids[x["doc_id"]]]
        start += x["n_tokens"]


def test_plain_words_reach_the_model_as_pre_tokens():
    """Letters and marks after them: ids as the library's, and no words are joined for it."""
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = token_output.Encoder(f.read())
    r = random.Random(8)
    letters = [chr(c) for c in range(0x41, 0x250) if token_output.PLAIN.fullmatch(chr(c))]
    assert len(letters) == 52 + 0x250 - 0xC0 - 2 and all(c.isalpha() for c in letters)
    marks = [chr(c) for c in range(33, 127) if token_output.PLAIN.fullmatch("a" + chr(c)) and not chr(c).isalpha()]
    assert len(marks) == 32 - 1  # no apostrophe
    plain = ["".join(r.choices(letters, k=r.randint(1, 9))) + "".join(r.choices(marks, k=r.choice([0, 0, 1, 2, 5]))) for _ in range(3000)]
    plain += [c + m for c in "aZ\u00e9\u0101" for m in ["", *marks]] + letters
    other = ["it's", "a1", "1a", "x.y", "\u00d7", "\u00aa", "(a)", "l'\u00e9t\u00e9", "we'll.", "a\nb", "."]
    texts = [" " + " ".join(r.sample(plain, 40)) for _ in range(200)] + [" " + " ".join(plain), plain[0], " ".join(plain[:9])]
    texts += [" ".join(r.sample(plain + 50 * other, 30)) for _ in range(200)]
    whole, given = encoder.whole, []
    encoder.whole = lambda texts: given.extend(texts) or whole(texts)
    ids, sizes = encoder(texts[:201])
    assert not given
    more, more_sizes = encoder(texts[201:])
    expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert np.concatenate([sizes, more_sizes]).tolist() == list(map(len, expected))
    assert np.concatenate([ids, more]).tolist() == [i for of in expected for i in of]


def test_paths_of_the_default_file_system_are_qualified(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert token_output.open_folder(common.qualified(spark, str(tmp_path)))[1] == str(tmp_path)
    try:
        conf.set("fs.defaultFS", "hdfs://localhost:8020")  # nothing connects
        assert common.qualified(spark, "/checkpoints/x") == "hdfs://localhost:8020/checkpoints/x"
        assert common.qualified(spark, f"file:{tmp_path}") == f"file:{tmp_path}"
    finally:
        conf.set("fs.defaultFS", before)


def test_token_files_of_an_empty_table(spark, tmp_path):
    docs = odd_documents(spark).limit(0)
    assert token_output.write_tokens(docs, P.path("byte_bpe_50k.json"), f"file://{tmp_path}/t").count() == 0


# -- 4: near duplicates ------------------------------------------------------
def groups_by_force(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, s) in enumerate(sets):
        for j, t in sets[:n]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in sets}


def test_near_duplicates_against_brute_force(spark):
    """Chains, a large group of near copies, and copies that share one passage only."""
    r = random.Random(5)
    vocabulary = [f"v{i}" for i in range(4000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((len(rows), " ".join(w)))
    for i in range(80):
        rows.append((len(rows), " ".join([*passage, *(r.choice(vocabulary) for _ in range(r.randint(10, 60)))])))
    chain = [r.choice(vocabulary) for _ in range(100)]
    for i in range(12):
        chain = chain[3:] + [r.choice(vocabulary) for _ in range(3)]
        rows.append((len(rows), " ".join(chain)))
    rows += [(len(rows) + i, rows[i][1].upper()) for i in range(0, 200, 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k in (4, 5):
        expected = groups_by_force(rows, k)
        got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(docs, k=k).collect()}
        assert got == expected


def groups_of_words(spark, sets):
    """(component_id of each document by the operator, by brute force); a document is a list of words."""
    rows = [(i, " ".join(s)) for i, s in enumerate(sets)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=1).collect()
    return {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got}, groups_by_force(rows, 1)


def test_near_duplicates_in_a_family_without_a_group(spark):
    """Template pages just under the threshold; pairs among them that share two words more."""
    template = [f"t{i}" for i in range(110)]
    own = [[f"o{i}x{j}" for j in range(15)] for i in range(200)]
    for i in range(40, 200, 4):
        own[i + 1][:2] = own[i][:2]
    got, expected = groups_of_words(spark, [template + x for x in own])
    assert len({c for _, c in expected.values()}) == 160
    assert got == expected


def test_near_duplicates_linked_to_one_member_of_a_large_group(spark):
    """Documents around a large group: each is linked to one member of it, or to one other outsider."""
    template = [f"t{i}" for i in range(100)]
    inside = [[f"i{i}x{j}" for j in range(10)] for i in range(150)]
    single = [[*inside[i + 30][:2], *(f"s{i}x{j}" for j in range(16))] for i in range(60)]
    paired = [[f"p{i // 2 if j < 4 else -i}x{j}" for j in range(16)] for i in range(1, 81)]
    got, expected = groups_of_words(spark, [template + x for x in inside + single + paired])
    assert len({c for _, c in expected.values()}) == 1 + 41
    assert got == expected


def test_near_duplicates_with_unlucky_signatures(spark):
    """Pairs of similarity 0.8 that share a band, and less than 0.7 of the minima."""
    sets = [[*(f"c{t}x{j}" for j in range(8)), f"{own}{t}"] for t in (4987, 11817, 16313, 16659) for own in "ab"]
    got, expected = groups_of_words(spark, sets)
    assert len({c for _, c in expected.values()}) == 4
    assert got == expected


def test_near_duplicates_of_one_large_family_take_few_passes(spark):
    """1,200 edited copies of one text around the threshold: as brute force, whatever their number
    without a round for each of them."""
    r = random.Random(11)
    vocabulary = [f"v{i}" for i in range(5000)]
    base = [r.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(1200):
        w = list(base)
        for at in r.sample(range(120), r.randint(2, 5)):
            w[at] = r.choice(vocabulary)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sc, group = spark.sparkContext, "near-copies-family"
    sc.setJobGroup(group, "")
    found = near_dedup.near_duplicates(docs, k=4).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in found}
    assert got == groups_by_force(rows, 4)
    jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    print(len({c for _, c in got.values()}), "groups", jobs, "jobs")
    assert jobs < 150


def test_near_duplicates_parities_bound_the_difference():
    """Two sets differ in at least as many hashes as parities, whatever their sizes."""
    r = np.random.default_rng(3)
    pool = np.unique(r.integers(0, 1 << 64, 6000, dtype=np.uint64))
    sets = [np.sort(r.choice(pool, n, replace=False)) for n in (0, 1, 2, 40, 150, 150, 900, 5000)]
    sets += [sets[4][10:], np.sort(np.concatenate([sets[4][20:], pool[:20]])), *[pool[i : i + 1] for i in range(near_dedup.PARITY_ROWS)]]
    packed = near_dedup.parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert packed.shape == (len(sets), near_dedup.PARITY_WORDS)
    bits = np.unpackbits(packed.view(np.uint8), axis=1)
    for i, x in enumerate(sets[:12]):
        for j, y in enumerate(sets):
            apart = int((bits[i] != bits[j]).sum())
            assert apart <= len(np.setxor1d(x, y)) and (apart - len(np.setxor1d(x, y))) % 2 == 0


def test_near_duplicates_pairs_of_a_family_under_the_threshold(spark):
    """Copies of one text that are all under the threshold, and some over it, share frequent shingles:
    the exact join makes few pairs besides those that are linked."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(140)]
    sets = []
    for i in range(150):
        out = set(r.sample(range(140), 12))  # 0.70 to 0.72 between two of them
        sets.append({w for j, w in enumerate(base) if j not in out} | {f"o{i}x{j}" for j in range(12)})
    sets += [{*sorted(sets[i])[:-2], f"n{i}"} for i in range(10)]
    hashes = [np.sort(np.array([xxhash.xxh64_intdigest(w) for w in x], dtype=np.uint64)) for x in sets]
    at = np.cumsum([0, *map(len, hashes)])
    values = np.concatenate(hashes)
    lows = near_dedup.low_bits(near_dedup.signatures(values, at)[1])
    times = collections.Counter(values.tolist())
    rows = []
    for node, own in enumerate(hashes):
        n = len(own)
        for place, x in enumerate(sorted(own.tolist(), key=lambda x: (times[x], x))):
            if times[x] > 1 and 100 * (n - place) >= 80 * n:
                shingle = int(np.uint64(x).astype(np.int64))
                rows.append((shingle, node, node, n, place, -1, *lows[node].tolist(), *near_dedup.parities(own, np.array([0, n]))[0].tolist()))
    bits = [f"bits{i} bigint" for i in range(near_dedup.BIT_WORDS)] + [f"odd{i} bigint" for i in range(near_dedup.PARITY_WORDS)]
    meeting = spark.createDataFrame(rows, "shingle bigint, node bigint, group bigint, n bigint, at bigint, largest bigint, " + ", ".join(bits))
    # Every set is a group of its own, and none is the largest.
    pairs = near_dedup.prefix_pairs(meeting, 80).collect()
    distinct = {(min(p), max(p)) for p in pairs}
    jaccard = lambda x, y: len(x & y) / len(x | y)
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard(sets[i], sets[j]) >= 0.8}
    assert len(linked) >= 10 and linked <= distinct
    assert len(distinct) < 0.1 * len(sets) ** 2 / 2


def test_near_duplicates_odd_inputs(spark):
    docs = odd_documents(spark)
    got = [(x["doc_id"], x["n_shingles"], x["component_id"], x["kept"]) for x in near_dedup.near_duplicates(docs, k=4).collect()]
    n = len(shingles(LONG, 4))
    assert sorted(got, key=repr) == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (None, 4, None, True), (3, 0, 3, True), (4, 7, 4, True), (4, 7, 4, True),
            (5, 7, 4, False), (6, 1, 6, True), (7, n, 7, True), (8, n + 1, 7, False),
            (9, len(shingles(ODD[-1][1], 4)), 9, True),
        ],
        key=repr,
    )
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_connected_components(spark):
    r = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(90)]
    frame = spark.createDataFrame([(r.choice([(u, v), (v, u)])) for u, v in edges], "u bigint, v bigint")
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v and find(u) != find(v):
            parent[max(find(u), find(v))] = min(find(u), find(v))
    assert {x["node"]: x["component"] for x in near_dedup.connected_components(frame).collect()} == {x: find(x) for x in parent}


# -- 5: quality --------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    got = quality.quality_query(spark, "/root/testdata/sf0.1")
    assert got.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.3 AS INT)").count() == 0
    held = got.where("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    right = held.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share"), F.count("*").alias("n"))
    share = {x["quality"]: x["share"] for x in right.collect()}
    assert share[0] >= 0.85 and share[1] >= 0.97


def test_quality_odd_inputs(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (6, None), (None, 1), (7, 0), (8, 1), (9, 0)], "doc_id bigint, quality int")
    model = quality.fit_quality(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= x["score"] <= 1 for x in rows)
    by = collections.defaultdict(set)
    for x in rows:
        by[x["doc_id"]].add(x["score"])
    assert len(by[4]) == 1 and by[1] == by[2]
    nothing = quality.fit_quality(docs.limit(0), labels)
    assert {x["score"] for x in quality.score_quality(docs, nothing).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).count() == 0


def spark_hash(*values):
    """Spark's xxhash64 of strings."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def passage_by_force(i, text, chars):
    start = spark_hash(str(i), "place") % max(len(text) - chars + 1, 1)
    return text[start : start + chars]


def dictionary_by_force(snippets):
    limit = max(n for n in range(4001) if sum(min(len(x), n) + 1 for x in snippets) <= 256 * 1024 or n == 0)
    return b"\n".join(x[:limit] for x in snippets)


def size_by_force(content, text):
    """Each 4096 bytes of a text alone against a raw-content dictionary."""
    of = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    of.precompute_compress(level=3)
    codec = zstandard.ZstdCompressor(level=3, dict_data=of, write_content_size=False, write_checksum=False, write_dict_id=False)
    return sum(len(codec.compress(text[i : i + 4096])) for i in range(0, len(text), 4096))


def test_quality_query_against_brute_force(spark):
    texts = texts_of(spark, SF_SMALL)
    marks = {}
    for i, q in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality").collect():
        if i is not None and q in (0, 1) and zlib.crc32(str(i).encode()) % 5:
            marks[i] = min(q, marks.get(i, 1))
    of = {}
    for q in (0, 1):
        ids = sorted((i for i in marks if marks[i] == q), key=lambda i: (spark_hash(str(i)), i))[:1500]
        of[q] = sorted((i for i in ids if texts.get(i) is not None), key=lambda i: int(str(i)[::-1].encode().hex(), 16) * 0x9E3779B97F4A7C15 % 2**64)
    good, bad = (dictionary_by_force([passage_by_force(i, texts[i], 2000).encode() for i in of[q][::2]]) for q in (1, 0))

    def row(text):
        g, b = size_by_force(good, text.encode()), size_by_force(bad, text.encode())
        ratio = math.log(min(g, b) / len(text.encode())) if text else 0.0
        return [(g - b) / (g + b) if text else 0.0, ratio, ratio**2]

    apart = sorted((i, q) for q in (0, 1) for i in of[q][1::2])
    w = quality.fit_logistic(np.array([row(texts[i]) for i, _ in apart]), np.array([float(q) for _, q in apart]))
    got = {x["doc_id"]: x for x in quality.quality_query(spark, SF_SMALL).collect()}
    assert len(got) == len(texts) and len(apart) > 10
    for i, text in texts.items():
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, [*row(text or ""), 1.0]))))
        assert got[i]["score"] == pytest.approx(score, rel=1e-9) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == (got[i]["score"] >= 0.3)


def test_language_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    first = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and text is not None and zlib.crc32(str(i).encode()) % 5:
            order = spark_hash(str(i), "language")
            key = lang, order % 256
            first[key] = min(first.get(key, (order, i, text)), (order, i, text))
    content = {
        lang: dictionary_by_force([passage_by_force(i, t, 1000).lower().encode() for (x, _), (_, i, t) in sorted(first.items(), key=lambda f: f[1]) if x == lang])
        for lang in sorted({x for x, _ in first})
    }
    got = {x["doc_id"]: x["lang_pred"] for x in language_id.language_query(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert got[i] == "und"
        else:
            assert got[i] == min(content, key=lambda x: size_by_force(content[x], text.lower().encode()))


def test_every_passage_is_in_the_dictionary():
    snippets = [bytes([65 + i]) * n for i, n in enumerate((10, 400, 30, 3000, 7, 900))]
    made = compression.dictionary(snippets, 500)
    assert len(made) <= 500 and set(made) == {10, *range(65, 71)}
    assert made.split(b"\n")[0] == snippets[0] and compression.dictionary(snippets, 10_000) == b"\n".join(snippets)
    assert compression.dictionary([]) == b""


# -- 6: language model -------------------------------------------------------
def lm_by_force(rows, train, order, strength):
    w = [[*words(t), None] for _, t in rows]
    taught = [x for x, t in zip(w, train) if t]
    counts = [collections.Counter(tuple(x[i : i + n]) for x in taught for i in range(len(x) - n + 1)) for n in range(1, order + 1)]
    total, distinct = sum(counts[0].values()), len(counts[0])

    def p(h, x):
        if not h:
            return (counts[0][(x,)] + 1) / (total + distinct + 1)
        n = len(h)
        return (counts[n][h + (x,)] + strength * p(h[1:], x)) / (counts[n - 1][h] + strength)

    out = []
    for x in w:
        base = sum(math.log10(p((), y)) for y in x)
        score = sum(math.log10(p(tuple(x[max(0, i - order + 1) : i]), y)) for i, y in enumerate(x))
        out.append((len(x), sum(counts[0][(y,)] > 0 for y in x), total, base, score))
    return out


def same_scores(got, expected):
    by = lambda rs: sorted(rs, key=lambda x: (repr(x[0]), x[1], round(x[4], 3)))
    for g, e in zip(by([tuple(x) for x in got]), by(expected), strict=True):
        assert g[:4] == e[:4] and g[4] == pytest.approx(e[4], rel=1e-9) and g[5] == pytest.approx(e[5], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_against_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 700)  # so that there are many blocks and buckets
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 1500)
    rows = [(i, t[:3000]) for i, t in list(texts_of(spark, SF_SMALL).items())[:60]] + [(i and 1000 + i, t) for i, t in ODD if t is None or len(t) < 1000]
    train = [i is not None and i % 3 != 0 for i, _ in rows]
    got = lm_scoring.score_documents(odd_documents(spark, rows), F.expr("doc_id % 3 <> 0"), order=order).collect()
    same_scores(got, [(i, *x) for (i, _), x in zip(rows, lm_by_force(rows, train, order, lm_scoring.STRENGTH))])


def test_language_model_query_against_brute_force(spark):
    """The query with its own parameters, over the whole table."""
    rows = list(texts_of(spark, SF_SMALL).items())
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = lm_scoring.lm_query(spark, SF_SMALL).collect()
    assert {x["doc_id"]: x["held_out"] for x in got} == {i: not t for (i, _), t in zip(rows, train)}
    kept = [(x["doc_id"], x["n_tokens"], x["n_known"], x["train_tokens"], x["base_score"], x["score"]) for x in got]
    same_scores(kept, [(i, *x) for (i, _), x in zip(rows, lm_by_force(rows, train, lm_scoring.ORDER, lm_scoring.STRENGTH))])


def test_an_ngram_is_known_in_a_corpus_of_any_size(spark):
    """A passage that occurs twice is known among few texts and among many of other words."""
    twice = "one passage that is in two texts and in no other text of the table"
    for others in (3, 3000):
        rows = [(1, twice), (2, twice)] + [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(3, 3 + others)]
        got = {x["doc_id"]: x for x in lm_scoring.score_documents(odd_documents(spark, rows), F.lit(True)).collect()}
        assert got[1]["score"] == got[2]["score"]
        # All but the first word and the second come from known trigrams: at least 2 / (2 + STRENGTH).
        known = (got[1]["n_tokens"] - 2) * math.log10(2 / (2 + lm_scoring.STRENGTH))
        assert got[1]["score"] > known + 2 * math.log10(1 / (22 * others + 100)) and got[1]["score"] > got[1]["base_score"]


def test_language_model_shares_add_up_to_one():
    """All words after a context, and what is left for unknown ones."""
    texts = [["a", "b", "a"], ["a", "b", "c"], ["b", "a"]]
    h = {w: np.uint64(i + 5) for i, w in enumerate("abc")} | {None: lm_scoring.END}
    every = [[*x, None] for x in texts]
    flat = np.array([h[w] for x in every for w in x], dtype=np.uint64)
    counts = [collections.Counter(g.tolist()) for _, g in lm_scoring.grams(flat, np.cumsum([0, *map(len, every)]), 3)]
    total, distinct = len(flat), 4

    def score(line):
        ends = np.array([0, len(line)])
        levels, arcs, n = lm_scoring.compose(line, ends, 3, lambda n, found: np.array([counts[n][x] for x in found.tolist()], dtype=np.int64))
        model = lm_scoring.compile_automaton(levels, total, distinct, 4.0)
        return float(lm_scoring.traverse(model, arcs, np.log10((n + 1) / (total + distinct + 1)), ends)[0])

    for context in (["a"], ["a", "b"], ["b", "c"], ["c", "c"]):
        line = [h[w] for w in context]
        # 99 is any unknown word.
        share = sum(10 ** (score(np.array([*line, x], dtype=np.uint64)) - score(np.array(line, dtype=np.uint64))) for x in [*h.values(), np.uint64(99)])
        assert share == pytest.approx(1.0)


def test_language_model_beats_its_unigrams_on_held_out_texts(spark):
    held = lm_scoring.lm_query(spark, SF_MID).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_language_model_without_rows(spark):
    docs = odd_documents(spark)
    rows = lm_scoring.score_documents(docs, F.lit(False)).collect()
    assert len(rows) == len(ODD) and {x["score"] for x in rows} == {0.0} and {x["n_known"] for x in rows} == {0}
    assert lm_scoring.score_documents(docs.limit(0), F.lit(True)).count() == 0


# -- 7: language -------------------------------------------------------------
def test_languages_of_held_out_texts(spark):
    got = language_id.language_query(spark, "/root/testdata/sf0.1").where("held_out")
    told = got.join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.96


def test_languages_odd_inputs(spark):
    docs = odd_documents(spark).withColumn("lang", F.when(F.col("doc_id") < 7, "en").when(F.col("doc_id") == 9, "xx"))
    model = language_id.fit_languages(docs)
    assert set(model) == {"en", "xx"}
    rows = {x["doc_id"]: x for x in language_id.identify_languages(docs, model).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and rows[5]["lang_pred"] == "en"
    assert all(0 <= x["score"] <= 1 for x in rows.values())
    assert {x["lang_pred"] for x in language_id.identify_languages(docs, model, min_margin=1.1).collect()} == {"und"}
    assert {x["lang_pred"] for x in language_id.identify_languages(docs, {}).collect()} == {"und"}
    assert language_id.identify_languages(docs.limit(0), model).count() == 0


# -- 9: SentencePiece --------------------------------------------------------
def test_transducer_against_the_library():
    spm = pytest.importorskip("sentencepiece")
    path = P.path("piece_bpe_32k.model")
    library, encoder = spm.SentencePieceProcessor(model_file=path), sp_fst.Encoder(sp_fst.Transducer(path))
    r = random.Random(1)
    vocabulary = list(encoder.transducer.id)
    texts = [t or "" for _, t in ODD] + [" " * n + "x" for n in range(40)]
    texts += ["".join(r.choice(vocabulary) for _ in range(30)).replace("\u2581", " ") for _ in range(500)]
    texts += ["".join(r.choice("ab cde \nthino12,.!é日") for _ in range(200)) for _ in range(500)]
    ids, sizes = encoder(texts)
    found = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert found == library.encode(texts, num_threads=1)
    assert [encoder.transducer.decode(x) for x in found] == [t.replace("\u2581", " ") for t in texts]


def test_unigram_weights_give_the_lightest_path():
    """The tropical shortest path of a unigram machine, against all segmentations."""
    t = sp_fst.Transducer.__new__(sp_fst.Transducer)
    t.bpe, t.score = False, {"a": -1.0, "b": -1.5, "ab": -2.2, "ba": -1.1, "aba": -3.5, "bb": -2.9}
    t.id, t.unknown_cost = {p: i for i, p in enumerate(t.score)}, 12.0
    t.suffixes = {p[i:]: False for p in t.id for i in range(len(p))} | dict.fromkeys(t.id, True)

    def best(text):
        if not text:
            return 0.0, []
        options = []
        for n in range(1, len(text) + 1):
            if text[:n] in t.id or n == 1:
                cost, rest = best(text[n:])
                options.append((cost - t.score.get(text[:n], -12.0), [text[:n], *rest]))
        return min(options)

    texts = sorted("".join(x) for n in range(1, 6) for x in __import__("itertools").product("abc", repeat=n))
    for text, path in zip(texts, t.shortest_paths(texts, {})):
        assert sum(-t.score.get(p, -12.0) for p in path) == pytest.approx(best(text)[0]) and "".join(path) == text


def test_sentencepiece_rows(spark):
    docs = odd_documents(spark)
    path = P.path("piece_bpe_32k.model")
    encoded = sp_fst.encode_documents(docs, path)
    rows = encoded.collect()
    assert len(rows) == len(ODD) and sum(not x["round_trip"] for x in rows) == 1  # the text with the space symbol
    texts = {x["doc_id"]: x["text"] for x in sp_fst.decode_documents(encoded, path).collect()}
    assert texts[7] == LONG and texts[1] == texts[2] == ""
    assert sp_fst.encode_documents(docs.limit(0), path).count() == 0


# -- 10: decontamination -----------------------------------------------------
def test_item_blocks_keep_both_bounds(spark):
    r = random.Random(5)
    rows = [(i, "w" * r.choice([0, 5, 90, 400])) for i in range(200)] + [(900, "w" * 5000), (900, "v" * 5000)]
    wanted = spark.createDataFrame(rows, "item_id bigint, text string")
    blocks = [[tuple(x) for x in b.collect()] for b in decontaminate.item_blocks(wanted, 30, 2000)]
    assert sorted(x for b in blocks for x in b) == sorted(rows)
    assert all(len(b) == 1 or (len(b) <= 30 and sum(len(t) for _, t in b) <= 2000) for b in blocks)
    assert len(blocks) < 40  # 44,000 bytes or so: blocks are filled
    assert decontaminate.item_blocks(wanted.limit(0), 30, 2000) == []
    assert len(decontaminate.item_blocks(wanted, 1000, 1 << 20)) == 1


def test_decontamination_against_brute_force(spark):
    r = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(r.choice([1, 3, 5, 9, 14, 20, 37, 59, 130])))) for i in range(60)]
    items += [(100, None), (101, ""), (None, "no id at all here now"), (102, items[7][1]), (103, "Short")]
    docs = [(i, " ".join(some(r.randint(0, 900)))) for i in range(150)]
    for n in range(100):  # whole, cut, edited, and split items inside documents
        item, text = r.choice(items[:60])
        w = text.split()
        w = {0: w, 1: w[: max(1, int(len(w) * 0.9))], 2: [x if r.random() > 0.03 else "edit" for x in w], 3: [*w[: len(w) // 2], *some(200), *w[len(w) // 2 :]]}[n % 4]
        i, t = docs[r.randrange(150)]
        docs.append((1000 + n, " ".join([*t.split(), *w, *some(40)])))
    docs += [(i and 5000 + i, t) for i, t in ODD]
    frame = odd_documents(spark, docs)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    expected = set()
    for i, t in docs:
        s = shingles(t, 5)
        for j, u in items:
            v = shingles(u, 5)
            if j is not None and v and len(s & v) >= 0.8 * len(v):
                expected.add((i, j, len(s & v), len(v)))
    for bounds in ({}, {"block_items": 9}, {"block_bytes": 3000}):  # one block of items, and several
        found = decontaminate.find_items(frame, bench, **bounds)
        assert {tuple(x) for x in found.collect()} == expected
    clean = {x["doc_id"] for x in decontaminate.decontaminate(frame, bench).collect()}
    assert clean == {i for i, _ in docs} - {i for i, *_ in expected if i is not None}
    assert decontaminate.find_items(frame.limit(0), bench).count() == 0
    assert decontaminate.find_items(frame, bench.limit(0)).count() == 0


# -- 8: URLs -----------------------------------------------------------------
def test_url_filter_odd_inputs(spark):
    pages = [
        (1, None), (2, ""), (3, "no scheme/x"), (4, "HTTP://WWW.Example.COM/en/a?b#c"), (5, "https://x.example.com/en/a"),
        (6, "https://example.net/es/"), (7, "https://example.org"), (8, "https://example.org/a.html"), (9, "https://m.example.org/a/"),
        (9, "https://m.example.org/a/"), (None, "https://example.org/a?x"), (10, "x://com"), (11, "x://notcom/"), (12, "://h/p?q://z"),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("maybe", F.lit(1)).withColumn("host", F.lit("?"))
    listed = spark.createDataFrame([("example.org/a",), ("example.org/a",), (None,), ("x.example.com/en/a",)], "url string")
    rules = [url_filter.Rule(*r) for r in url_filter.RULES]
    for blocks in (1, url_filter.MAX_BLOCKS):  # a filter that passes everything, and a sparse one
        rows = url_filter.filter_urls(frame, listed, rules, max_blocks=blocks).collect()
        got = sorted(((x["page_id"], x["host"], x["path"], x["rule"], x["verdict"], x["listed"]) for x in rows), key=repr)
        assert got == sorted(
            [
                (1, "", "", None, "allow", False), (2, "", "", None, "allow", False), (3, "", "", None, "allow", False),
                (4, "www.example.com", "/en/a", "www.example.com/en/", "allow", False),
                (5, "x.example.com", "/en/a", "example.com/en/", "block", True),
                (6, "example.net", "/es/", "net/es/", "block", False), (7, "example.org", "", None, "allow", False),
                (8, "example.org", "/a.html", None, "block", True), (9, "m.example.org", "/a/", None, "block", True),
                (9, "m.example.org", "/a/", None, "block", True), (None, "example.org", "/a", None, "block", True),
                (10, "com", "", None, "allow", False), (11, "notcom", "/", None, "allow", False), (12, "h", "/p", None, "allow", False),
            ],
            key=repr,
        )
    assert url_filter.filter_urls(frame.limit(0), listed, rules).count() == 0
    assert {x["listed"] for x in url_filter.filter_urls(frame, listed.limit(0), rules).collect()} == {False}
