"""Line dedup (1), SimHash groups (7) and exact groups (8) against brute force and on edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from edge_rows import CLASHING, LONG
from pyspark.sql import functions as F

import corpus_pipeline
from visitflow.llm import exact_dedup, line_dedup, queries, simhash
from visitflow.llm.common import Scratch, documents
from visitflow.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def union(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingle_sets(lines, width=9):
    return [{x[i:i + width] for i in range(max(1, len(x) - width + 1))} for x in lines]


def brute_lines(rows, width=9):
    """Lines to drop by (doc, line), all pairs of different lines compared."""
    where = defaultdict(list)
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                where[line].append((doc, i))
    lines = list(where)
    sets, index, links = shingle_sets(lines, width), defaultdict(list), []
    for n, s in enumerate(sets):
        for m, k in Counter(m for g in s for m in index[g]).items():
            if k / (len(s) + len(sets[m]) - k) >= 0.8:
                links.append((m, n))
        for g in s:
            index[g].append(n)
    groups = defaultdict(list)
    for n, c in enumerate(union(len(lines), links)):
        groups[c] += where[lines[n]]
    return {x for g in groups.values() for x in sorted(g)[1:]}


def dropped(df, **options):
    return {(r.doc_id, r.line) for r in line_dedup.duplicate_lines(df, **options).where("NOT kept").collect()}


@pytest.mark.parametrize("width", [line_dedup.SHINGLE, line_dedup.NEAR_SHINGLE])
def test_lines_match_brute_force(spark, width):
    docs = documents(spark, SF)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert dropped(docs, width=width) == brute_lines(rows, width)


def test_line_variants_of_one_family_form_one_class(spark):
    """Chains of small edits: neighbours are similar, ends are not; blocks of a band are compared in full."""
    random.seed(3)
    base = "".join(random.choice("abcdefghijklmnop ") for _ in range(300))
    rows, text = [], base
    for i in range(60):
        at = random.randrange(300)
        text = text[:at] + random.choice("qrstuv") + text[at + 1:]
        rows.append((i, text))
    other = "".join(random.choice("abcdefghijklmnop ") for _ in range(300))
    rows += [(100 + i, other) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dropped(df) == brute_lines(rows)


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 4)
    random.seed(5)
    rows = []
    for family in range(4):
        text = "".join(random.choice("abcdefgh ") for _ in range(120))
        for i in range(15):
            at = random.randrange(120)
            text = text[:at] + random.choice("xyz") + text[at + 1:]
            rows.append((family * 100 + i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.duplicate_lines(df, bands=20, rows=1)          # nearly all lines meet: false candidates too
    assert {(r.doc_id, r.line) for r in got.where("NOT kept").collect()} == brute_lines(rows)


def test_stars_across_batches():
    rows = [(1, 5), (1, 5), (1, 7), (2, 1), (3, 2), (3, 4), (3, 9), (4, 4), (4, 4), (5, 1), (5, 2)]
    frame = pd.DataFrame(rows, columns=["band", "key"]).astype("int64")
    want = {(1, 5, 5), (1, 5, 7), (3, 2, 2), (3, 2, 4), (3, 2, 9), (5, 1, 1), (5, 1, 2)}
    for cut in range(1, len(rows) + 1):
        parts = [frame.iloc[i:i + cut].reset_index(drop=True) for i in range(0, len(rows), cut)]
        got = [tuple(r) for f in line_dedup._stars(iter(parts)) for r in f[["band", "rep", "key"]].values.tolist()]
        assert sorted(got) == sorted(want), cut


def test_band_rows_leave_the_task_packed():
    lines = [f"line {i} of many that share {i % 7} words" for i in range(500)] + ["ab", "ab "]
    texts = ["\n".join(lines[:300]), None, "", "\n".join(lines[200:])]
    found = pd.concat(line_dedup._pack_bands(15, 5, 5)(iter([pd.DataFrame({"text": texts})])))
    assert list(found.columns) == ["part", "rows"] and found["part"].is_unique       # a row for each part, not for each band
    assert sum(map(len, found["rows"])) == len(lines) * 15 * 16                       # repeated lines once
    both = np.frombuffer(b"".join(found["rows"]), np.int64).reshape(-1, 2)
    bands, sizes = line_dedup._signed(lines, 15, 5, 5)
    want = {(int(b) >> 16, n, line_dedup.line_key(x)) for x, row, n in zip(lines, bands, sizes.tolist()) for b in row}
    assert {(b >> 16, b & 0xFFFF, k) for b, k in both.tolist()} == want
    assert sizes.tolist() == [len(line_dedup.shingles(x, 5)) for x in lines]


def test_only_lines_of_fitting_sizes_meet():
    def rows(part, *values):
        return pd.DataFrame({"part": [part], "rows": [np.array([(b << 16 | n, k) for b, n, k in values], np.int64).tobytes()]})
    parts = [rows(1, (5, 100, 30), (5, 79, 10), (6, 50, 10), (5, 300, 20)), rows(1, (6, 63, 40), (5, 100, 30)),
             rows(2, (7, 10, 1), (8, 0xFFFF, 3), (8, 0xFFFF, 2))]
    got = [(b >> 16, k) for f in line_dedup._unpack_bands(0.8)(iter(parts)) for b, k in f.values.tolist()]
    assert got == [(5, 10), (5, 30), (5, 30), (6, 10), (6, 40), (8, 2), (8, 3)]       # 79 and 100: one may be miscounted
    for a, b in ((100, 80), (125, 100), (35, 28), (5, 4)):                            # the exact limit always meets
        got = pd.concat(line_dedup._unpack_bands(0.8)(iter([rows(0, (1, a, 1), (1, b, 2))])))
        assert len(got) == 2


@pytest.mark.parametrize("width", [1, 2, 5, 9])
def test_shingle_ids_are_exact(width):
    rng = random.Random(width)
    for _ in range(400):
        a = "".join(rng.choices(rng.choice(["abc dé", "abш漢🙂"]), k=rng.randint(1, 30)))
        b = list(a) + rng.choice([[], ["x"]])
        b[rng.randrange(len(b))] = rng.choice("abш漢 ")
        x, y = (line_dedup.shingle_ids(z, width) for z in (a, "".join(b)))
        p, q = line_dedup.shingles(a, width), line_dedup.shingles("".join(b), width)
        assert len(x) == len(p) and line_dedup.similar_ids(x, y, 0.6, width) == line_dedup.similar(p, q, 0.6)


def test_no_stored_table_holds_signatures_or_texts_twice(spark, monkeypatch):
    saved, save = [], line_dedup.Scratch.save
    monkeypatch.setattr(line_dedup.Scratch, "save", lambda self, df, name: saved.append((name, df.columns)) or save(self, df, name))
    df = spark.createDataFrame([(i, f"one line that is nearly the same {i}\nalone {i * 7919}") for i in range(40)], "doc_id long, text string")
    drops = line_dedup.dropped_lines(df, width=5)
    assert not [n for n, columns in saved if "bands" in columns]
    assert [n for n, columns in saved if "text" in columns] == ["texts", "pair_texts", "near_texts"]
    assert "bands" not in dict(saved) and {r.n_lines for r in drops.collect()} == {2}


def test_filter_holds_every_key(spark):
    keys = [0, 1, -1, 32767, 32768, 32769, (1 << 26) - 1, 1 << 26, -(1 << 63), (1 << 63) - 1]
    bitmap = line_dedup._filter(spark.createDataFrame([(k,) for k in keys], "key long"))
    for k in keys:
        slot = k % (len(bitmap) * 8)
        assert bitmap[slot >> 3] >> (slot & 7) & 1
    assert int(np.unpackbits(bitmap).sum()) == len({k % (len(bitmap) * 8) for k in keys})


def test_signatures_find_similar_lines():
    random.seed(1)
    hits = 0
    for _ in range(200):
        a = "".join(random.choice("abcdefghijklmnopqrst ") for _ in range(400))
        b = list(a)
        for _ in range(4):
            b[random.randrange(400)] = "Z"
        b = "".join(b)
        x, y = line_dedup.sign([a, b])
        if line_dedup.jaccard(line_dedup.shingles(a), line_dedup.shingles(b)) >= 0.8:
            hits += bool((x == y).any())
        else:
            hits += 1
    assert hits >= 197
    assert (line_dedup.sign(["ab", "ab", "ac"])[0] == line_dedup.sign(["ab"])[0]).all()


def replaced(length, low, high, n=400):
    """Lines and copies with a stretch replaced, of a 5-character Jaccard similarity from ``low`` to ``high``."""
    random.seed(length)
    out = []
    while len(out) < n:
        a = "".join(random.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(length))
        cut = random.randrange(1, length // 2)
        at = random.randrange(length - cut)
        b = a[:at] + "".join(random.choice("ABCDEFGHIJKL") for _ in range(cut)) + a[at + cut:]
        s = line_dedup.jaccard(line_dedup.shingles(a, 5), line_dedup.shingles(b, 5))
        if low <= s <= high:
            out.append((a, b, s))
    return out


@pytest.mark.parametrize("length", [40, 60, 80, 200, 400])
def test_bands_of_short_lines_follow_the_formula(length):
    """Similar lines meet, unlike ones no more often than independent values would let them."""
    for low, high, room in ((0.28, 0.34, 0.05), (0.47, 0.53, 0.1), (0.8, 0.9, 0.01)):
        pairs = replaced(length, low, high)
        x, y = (line_dedup.sign([p[i] for p in pairs], width=5) for i in (0, 1))
        met = (x == y).any(axis=1).mean()
        want = np.mean([1 - (1 - s ** line_dedup.ROWS) ** line_dedup.BANDS for *_, s in pairs])
        assert abs(met - want) <= room
        assert low < 0.8 or met >= 0.99


def test_pairs_are_marked_only_in_bands_of_two():
    rows = [(1, 5), (1, 7), (2, 1), (3, 2), (3, 4), (3, 9), (4, 4), (5, 1), (5, 2), (6, 1), (6, 2)]
    frame = pd.DataFrame(rows, columns=["band", "key"]).astype("int64")
    for cut in range(1, len(rows) + 1):
        parts = [frame.iloc[i:i + cut].reset_index(drop=True) for i in range(0, len(rows), cut)]
        got = pd.concat(line_dedup._stars(iter(parts)))
        assert not got.loc[got["pair"], "band"].isin([2, 3, 4]).any(), cut
        assert (got.groupby("band")["pair"].nunique() == 1).all(), cut
    assert got["pair"].any()


def test_bands_hold_their_recall():
    """The bands in use, and those of more rows, find a pair of Jaccard 0.8 with probability 0.997 or more."""
    assert 1 - (1 - 0.8 ** line_dedup.ROWS) ** line_dedup.BANDS >= 0.997
    for rows in range(1, 9):
        assert 1 - (1 - 0.8 ** rows) ** line_dedup.bands_for(rows) >= 0.997


def test_sketches_never_part_similar_lines():
    random.seed(12)
    parted = 0
    for _ in range(300):
        x = "".join(random.choice("abcdefgh ") for _ in range(random.choice((3, 5, 30, 60, 400, 3000))))
        y = list(x)
        for _ in range(random.choice((0, 1, 2, len(x) // 40, len(x)))):
            y[random.randrange(len(y))] = random.choice("xyz")
        y = "".join(y)
        p, q = line_dedup.sketches([x, y], 5)
        if line_dedup.apart(p, q, line_dedup.places(x, 5) + line_dedup.places(y, 5), 0.8):
            parted += 1
            assert line_dedup.jaccard(line_dedup.shingles(x, 5), line_dedup.shingles(y, 5)) < 0.8
    assert parted > 50


def test_copies_with_one_edit_are_found(spark, scratch):
    """Of lines of 55 to 85 characters that differ in one character, op1 and the pipeline keep one."""
    random.seed(11)
    rows = []
    for n in range(60):
        line = "".join(random.choice("abcdefghijklmnopqrst ") for _ in range(55 + n // 2))
        at = random.randrange(8, len(line) - 8)
        rows += [(2 * n, line, 0), (2 * n + 1, line[:at] + "Z" + line[at + 1:], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r.n_dropped for r in queries.op1_line_minhash(spark, scratch).collect()}
    assert sum(got.values()) >= 58 and all(got[i] == 0 for i in got if i % 2 == 0)
    kept = {r.doc_id for r in corpus_pipeline.dedup_lines(spark, docs, scratch).collect()}
    assert kept == {i for i in got if not got[i]}


def test_lines_edge_cases(spark, edge, nothing):
    rows = line_dedup.dedup_lines(edge)
    assert rows.columns == edge.columns
    got = sorted(((r.doc_id, r.text) for r in rows.collect()), key=str)
    assert all(r.score == "kept score" for r in rows.select("score").collect())
    texts = [t for _, t in got]
    assert (2, None) in got and (3, "") in got and (4, " \t\n \r ") in got and (None, None) in got
    assert texts.count(LONG) == 1                                    # document 7 only held lines of document 6
    assert (8, "tie\nties are broken by the smallest id of all the documents here") in got
    assert not any(d == 9 for d, _ in got)
    assert sum(t is not None and t.startswith("The same text") for t in texts) == 1
    assert (10, "x") in got and any(t and t.startswith("A text without an id") for t in texts)
    assert len(got) == 10
    assert line_dedup.dedup_lines(nothing).count() == 0


def brute_fingerprint(text, width=4):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    parts = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(spark):
    docs = documents(spark, SF)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    comp = union(len(rows), links)
    low = defaultdict(lambda: 1 << 60)
    for (doc, _), c in zip(rows, comp):
        low[c] = min(low[c], doc)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.simhash_groups(docs).collect()}
    assert got == {doc: (f, low[c]) for (doc, _), f, c in zip(rows, fps, comp)}


def test_fingerprint_is_native_xxhash64(spark):
    text = "Ünïcode wörds and Ä B"
    row = spark.range(1).select(F.xxhash64(F.lit("word")).alias("h")).first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"word", 42)
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("tree_rows", [3, 2048])
def test_every_link_of_a_hot_shard_is_found(spark, tree_rows):
    """Fingerprints that crowd one shard, in one tree and in many."""
    random.seed(9)
    fps = {0}
    while len(fps) < 150:
        fps.add(sum(1 << random.randrange(20) for _ in range(random.randrange(6))))
    fps = sorted(fps)
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = simhash.fingerprint_links(df, Scratch(spark, "t"), tree_rows=tree_rows)
    assert {(min(r), max(r)) for r in got.collect()} == want


def test_bk_tree_follows_only_edges_in_the_radius():
    random.seed(2)
    values = list({random.getrandbits(64) for _ in range(300)} | {1, 2, 3})
    tree = simhash.BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q, 12)) == sorted(v for v in values if (v ^ q).bit_count() <= 12)


def test_simhash_edge_cases(spark, edge, nothing):
    got = simhash.simhash_groups(edge)
    assert got.count() == edge.count()
    blank = {(r.doc_id, r.component_id) for r in got.where("fp = 0").collect()}
    assert blank == {(2, 2), (3, 2), (4, 2), (None, 2)}              # blanks link like any other
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert ids == [-1, 1, 1, 2, 6, 8, 9, 10]
    assert simhash.drop_near_copies(nothing).count() == 0


def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = defaultdict(list)
    for i, n in enumerate(norm):
        groups[n].append(i)
    out = []
    for i, n in enumerate(norm):
        best = min(groups[n], key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0, j))
        out.append((rows[i][0], rows[best][0], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups_by_names_not_hashes(spark, edge, bits):
    """With three hash bits nearly all blocks collide: contents decide, the result is the same."""
    got = exact_dedup.exact_groups(edge, block_bytes=16 if bits == 3 else 4096, hash_bits=bits).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute_exact(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})


def test_exact_groups_of_nothing(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_blocks_cut_inside_characters(spark):
    rows = [(1, "é" * 50), (2, "é" * 49 + "e"), (3, " é" * 50), (4, "é" * 49)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=7).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)]
    links += [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2100)] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3), (3, None)], "u long, v long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "t")).collect()}
    comp = union(3000, links)
    assert got == {n: comp[n] for pair in links for n in pair if pair[0] != pair[1]}


def test_components_of_links_found_in_the_same_worker(spark):
    """The links may be what a function makes of the rows, in frames of any size."""
    random.seed(5)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)]

    def made(batches):
        for b in batches:
            for i in range(0, len(b), 7):
                yield pd.DataFrame({"u": -b["a"][i:i + 7], "v": -b["b"][i:i + 7]})
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(df, Scratch(spark, "t"), made_by=made).collect()}
    largest = {}
    comp = union(1200, links)
    for pair in links:
        for n in pair:
            largest[comp[n]] = max(largest.get(comp[n], 0), n)
    assert got == {-n: -largest[comp[n]] for pair in links for n in pair if pair[0] != pair[1]}


def test_search_hands_links_on_in_chunks(monkeypatch):
    values = sorted({1 << i for i in range(24)})
    frame = pd.DataFrame([(0, 0, role, v) for role in (0, 1) for v in values], columns=["shard", "part", "role", "fp"])
    want = {(a, b) for a in values for b in values if a < b}
    monkeypatch.setattr(simhash, "LINKS_CHUNK", 10)
    frames = list(simhash._search(4)(iter([frame])))
    assert max(map(len, frames)) < 10 + len(values)
    found = [pair for f in frames for pair in zip(f["u"].tolist(), f["v"].tolist())]
    assert len(found) == len(set(found)) and {(min(p), max(p)) for p in found} == want


def python_steps(df):
    """Python evaluations of each stage of a frame's plan: a task holds a Python worker for each of them."""
    def walk(node, stages, at):
        name = node.nodeName()
        if "Exchange" in name:
            stages.append([])
            at = len(stages) - 1
        elif re.search("InPandas|InArrow|EvalPython", name):
            stages[at].append(name)
        for i in range(node.children().size()):
            walk(node.children().apply(i), stages, at)
        return stages
    plan = df._jdf.queryExecution().executedPlan()
    return walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan, [[]], 0)


def test_tasks_of_the_pipeline_hold_one_python_worker(spark, tmp_path, monkeypatch):
    """An executor keeps the workers of a task, so a second one in a row costs its memory in all later stages too."""
    near = [f"one two three four five six seven eight {w} ten eleven twelve" for w in ("nine", "nein", "neuf")]
    rows = [(i, f"{near[i % 3]}\nline number {i} of this text", "en", "web", "art", 60) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 5 == 0) for i in range(30)], "doc_id long, toxic boolean") \
        .selectExpr("doc_id", "cast(toxic as int) as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    save, stages = Scratch.save, []

    def saved(self, df, name):
        stages.extend((name, s) for s in python_steps(df))
        return save(self, df, name)
    monkeypatch.setattr(Scratch, "save", saved)
    last = corpus_pipeline.run(spark, str(tmp_path))
    stages += [("bpe", s) for s in python_steps(last)]
    assert sum(len(s) for _, s in stages) >= 9
    assert [x for x in stages if len(x[1]) > 1] == []


def test_clashing_names_are_many():
    assert len(CLASHING) > 20
