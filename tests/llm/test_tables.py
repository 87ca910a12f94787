"""Sharding (2), mixing (5), quality rules (10) and the pipeline: laws, brute force and edge cases."""

import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitflow.llm import mixing, quality, queries, sharding
from visitflow.llm.common import Scratch, documents, table

SF = "/root/testdata/sf0.001"


def shard_rows(df, **options):
    sized = df.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
                      F.xxhash64(F.coalesce("text", F.lit(""))).alias("g"))
    return sharding.histogram_shards(sized, ["g"], ["doc_id"], "size", **options)


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_shards_are_near_equal_and_slots_gapless(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = shard_rows(docs).collect()
    assert len(rows) == docs.count() and {r.shard for r in rows} == set(range(16))
    check_slots(rows)
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    largest = max(r.size for r in rows)
    mean = sum(size.values()) / 16
    assert all(abs(s - mean) <= largest for s in size.values())      # a cut misses its target by half a document


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(i, "copy " * 20 if i % 3 else f"text {i} " * 12) for i in range(3000)]
    got = shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), shards=8, ranges=5).collect()
    slots = check_slots(got)
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert len(slots) == 8 and max(size.values()) <= 1.01 * min(size.values()) + 120
    order = [g for _, _, g in sorted((r.shard, r.slot, r.g) for r in got)]
    runs = 1 + sum(a != b for a, b in zip(order, order[1:]))
    assert runs == len(set(order))                                   # groups lie side by side


def test_a_range_of_one_key_and_of_many_short_rows(spark):
    """Equal keys cannot be cut; ranges are bounded in rows as well as bytes."""
    rows = [(1, "same")] * 200 + [(i, "") for i in range(2, 400)]
    got = shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    assert len(got) == 598 and len({r.shard for r in got if r.doc_id == 1}) == 1
    check_slots(got)


def test_thousands_of_ranges(spark):
    """Plans do not grow with the ranges: a hot group with a third of the rows, 5,000 ranges, 600 shards."""
    df = spark.range(60_000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 40 + 1).alias("size"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 9_001).alias("g"))
    got = sharding.histogram_shards(df, ["g"], ["doc_id"], "size", shards=600, ranges=5_000)
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 60_000
    slots, size = check_slots(rows), Counter()
    for r in rows:
        size[r.shard] += r.size
    assert set(slots) == set(range(600)) and max(size.values()) - min(size.values()) <= 3 * 40
    tasks = Counter(r.task for r in rows)
    assert len(tasks) > 2_000 and max(tasks.values()) <= 2 * 60_000 / 5_000 + 1
    order = [g for _, _, g in sorted((r.shard, r.slot, r.g) for r in rows)]
    assert 1 + sum(a != b for a, b in zip(order, order[1:])) == len(set(order))


def test_located_keys_equal_bisect(spark):
    random.seed(5)
    for n in (1, 2, 3, 7, 8, 100):
        points = sorted({(random.randint(0, 9), random.randint(0, 3)) for _ in range(n)})
        df = spark.range(40).selectExpr("id div 4 AS k1", "id % 4 AS k2")
        for r in df.withColumn("at", sharding._locate(points)).collect():
            assert r.at == bisect_right(points, (r.k1, r.k2))


def test_sharding_edge_cases(spark, edge, nothing):
    got = sharding.histogram_shards(edge, ["text"], ["doc_id"], "n_chars", shards=3)
    assert set(got.columns) == set(edge.columns)                     # shard and slot replaced, the rest kept
    rows = got.collect()
    assert len(rows) == edge.count() and all(r.k1 == "kept k1" and r.bin == "kept bin" for r in rows)
    check_slots(rows)
    assert sharding.histogram_shards(nothing, ["text"], ["doc_id"], "n_chars").count() == 0


def brute_ipf(cells, targets, sweeps=400):
    w = {k: float(v) for k, v in cells.items()}
    for _ in range(sweeps):
        for i, t in enumerate(targets):
            held = Counter()
            for k, x in w.items():
                held[k[i]] += x
            w = {k: x * t[k[i]] / held[k[i]] for k, x in w.items()}
    return {k: w[k] / cells[k] for k in cells}


def test_raking_equals_brute_force(spark):
    random.seed(2)
    rows = [(i, random.choice("aaab"), random.choice("xyyz"), random.randint(1, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n long")
    margins = {"source": 0.5, "lang": 0.3}
    got, names = mixing.mix(df, margins, F.col("n"), trim=1e9)
    cells = Counter()
    for _, s, g, n in rows:
        cells[s, g] += n
    whole, targets = sum(cells.values()), []
    for i, e in enumerate(margins.values()):
        held = Counter()
        for k, n in cells.items():
            held[k[i]] += n
        power = {k: v ** e for k, v in held.items()}
        targets.append({k: whole * p / sum(power.values()) for k, p in power.items()})
    want = brute_ipf(cells, targets)
    out = got.collect()
    top = max(want.values())
    for r in out:
        assert r[names["weight"]] == pytest.approx(want[r.source, r.lang], rel=1e-4)
        assert r[names["probability"]] == pytest.approx(want[r.source, r.lang] / top, rel=1e-4)
    share = sum(r[names["sampled"]] for r in out) / len(out)
    assert share == pytest.approx(sum(r[names["probability"]] for r in out) / len(out), abs=0.04)


@pytest.mark.parametrize("exponents", [queries.MIX_EXPONENTS, corpus_pipeline.MIX_EXPONENTS])
def test_rare_sources_reach_their_targets(spark, exponents):
    """The settings of op5 and the pipeline, sources from a third of all tokens down to a millionth of that."""
    sizes = {"huge": 10 ** 9, "large": 10 ** 9, "big": 9 * 10 ** 8, **{f"rare{k}": 10 ** 9 // 10 ** k for k in range(2, 7)}}
    rows = [(i, s, g, t, n // 6) for i, (s, n, g, t) in enumerate(
        (s, n, g, t) for s, n in sizes.items() for g in ("en", "de", "fr") for t in ("prose", "list"))]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n long")
    out, names = mixing.mix(df, exponents, F.col("n"))
    out = out.collect()
    whole = sum(r[names["weight"]] * r.n for r in out)
    power = {s: (n // 6 * 6) ** exponents["source"] for s, n in sizes.items()}
    for s in sizes:
        share = sum(r[names["weight"]] * r.n for r in out if r.source == s) / whole
        assert share == pytest.approx(power[s] / sum(power.values()), rel=1e-4)
    for r in out:
        assert [x.margin for x in r[names["shares"]]] == list(exponents)
        assert all(x.achieved == pytest.approx(x.target, rel=1e-4) for x in r[names["shares"]])


def test_rows_without_an_id_have_draws_of_their_own(spark):
    """A third of the rows without an id and a third with one id, all of one text; two splits of the input agree."""
    rows = [(None if i % 3 == 0 else -1 if i % 3 == 1 else i, "the same text", "b" if i % 40 else "a", 10) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    drawn = []
    for parts in (1, 7):
        out, names = mixing.mix(df.repartition(parts), {"source": 0.8}, F.col("n"))
        out = out.collect()
        assert len(out) == len(rows)
        for key in (None, -1):
            same = [r for r in out if r.doc_id == key and r.source == "b"]
            share = sum(r[names["sampled"]] for r in same) / len(same)
            assert 0.05 < same[0][names["probability"]] < 0.95
            assert share == pytest.approx(same[0][names["probability"]], abs=0.05)
        drawn.append(Counter((r.doc_id, r.source) for r in out if r[names["sampled"]]))
    assert drawn[0] == drawn[1]


def test_sample_meets_the_margins(spark):
    rows = mixing.mix(documents(spark, "/root/testdata/sf0.1").select("doc_id", "lang", "source", "text"),
                      {"lang": 0.0, "source": 1.0}, mixing.word_count())[0].drop("text").collect()
    held = Counter()
    for r in rows:
        held[r.lang] += r.tokens * r.sampled
    assert max(held.values()) / min(held.values()) < 1.35            # equal targets; documents are long and few


def test_targets_given_by_value(spark):
    random.seed(4)
    rows = [(i, random.choice(["a", "a", "a", "b", "c", "d", None]), random.choice("xyyz"), random.randint(1, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n long")
    out, names = mixing.mix(df, {"source": {"a": 0.2, "b": 0.4, None: 0.1}, "lang": {"x": 0.6, "y": 0.2, "z": 0.2}}, F.col("n"))
    got = out.select("source", "lang", (F.col(names["tokens"]) * F.col(names["weight"])).alias("w"), "n").collect()
    held, whole = Counter(), sum(r.w for r in got)
    for r in got:
        held[r.source] += r.w / whole
        held["lang " + r.lang] += r.w / whole
    c, d = (sum(r.n for r in got if r.source == k) for k in "cd")
    want = {"a": 0.2, "b": 0.4, None: 0.1, "c": 0.3 * c / (c + d), "d": 0.3 * d / (c + d), "lang x": 0.6, "lang y": 0.2, "lang z": 0.2}
    assert all(abs(held[k] - x) < 1e-5 for k, x in want.items())
    # shares of 1 leave out what is not listed; a share without tokens goes to the others
    out, names = mixing.mix(df, {"source": {"a": 0.25, "b": 0.25, "absent": 0.5}}, F.col("n"))
    kept = Counter()
    for r in out.collect():
        kept[r.source] += r[names["tokens"]] * r[names["weight"]]
    assert kept["c"] == kept["d"] == kept[None] == 0 and abs(kept["a"] / kept["b"] - 1) < 1e-5
    assert out.where(F.col("source") == "c").where(names["sampled"]).count() == 0


def test_contradicting_targets_raise(spark):
    df = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "y", 5)], "doc_id long, source string, lang string, n long")
    margins = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}
    with pytest.raises(ValueError, match="raking ended"):
        mixing.mix(df, margins, F.col("n"), strict=True)
    with pytest.raises(ValueError, match="more than 1"):
        mixing.mix(df, {"source": {"a": 0.9, "b": 0.3}}, F.col("n"))


def test_mixing_edge_cases(spark, edge, nothing):
    rows, names = mixing.mix(edge, {"source": 0.5, "lang": 0.5}, mixing.word_count())
    assert names["tokens"] == "_tokens" and names["weight"] == "_weight"
    got = rows.collect()
    assert len(got) == edge.count() and all(0 < r[names["probability"]] <= 1 for r in got)
    assert all(r.tokens == "kept tokens" for r in got)
    drawn = mixing.sampled_documents(edge, {"source": 0.5, "topic": 0.5})
    assert drawn.columns == edge.columns and 0 < drawn.count() <= edge.count()
    assert mixing.mix(nothing, {"source": 0.5}, mixing.word_count())[0].count() == 0


def brute_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(w, w[1:], w[2:]))
    cover = {j for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover))


@pytest.mark.parametrize("bits", [24, 60])
def test_statistics_equal_brute_force(spark, edge, monkeypatch, bits):
    """With 60 position bits 4 bits of hash are left: windows collide and the plain way decides."""
    monkeypatch.setattr(quality, "POSITION_BITS", bits)
    random.seed(8)
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect() if r.text is None or len(r.text) < 1000]
    rows += [(r.doc_id, r.text) for r in documents(spark, SF).limit(60).collect()]
    rows += [(i, " ".join(random.choice("abc") for _ in range(random.randrange(40)))) for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in quality.statistics(df).collect()}
    assert got == {i: brute_statistics(t) for i, (_, t) in enumerate(rows)}


def test_learnt_list_rejects_what_labels_reject(spark):
    sf = "/root/testdata/sf0.1"
    rows, rules = quality.quality(documents(spark, sf), table(spark, sf, "labels"))
    assert rules and all(1 <= len(r) <= quality.MAX_CONDITIONS for r in rules)
    got = rows.join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.98
    assert n.get((0, False), 0) / (n.get((0, False), 0) + n.get((0, True), 0)) > 0.7
    row = rows.where("rule IS NOT NULL").first()
    assert not row.kept and row.rule == " and ".join(map(str, next(r for r in rules if row.rule.startswith(str(r[0])))))


def test_rules_come_in_order(spark):
    """Two kinds of bad rows: two rules, the larger kind first; verdict is one conditional expression."""
    random.seed(6)
    rows = []
    for i in range(1200):
        kind = "symbols" if i % 10 < 3 else "loud" if i % 10 == 3 else "good"
        rows.append((i, *[0.0] * len(quality.FEATURES), int(kind == "good"), kind))
    stats = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{f} double" for f in quality.FEATURES)
                                  + ", quality int, kind string")
    noise = F.rand(5)
    stats = stats.withColumns({"symbol_share": F.when(F.col("kind") == "symbols", 1 + noise).otherwise(noise * 0.2),
                               "upper_share": F.when(F.col("kind") == "loud", 0.8 + noise * 0.2).otherwise(noise * 0.5)})
    stats = Scratch(spark, "t").write(stats, "stats")
    rules = quality.learn(stats.drop("quality"), stats.select("doc_id", "quality"), Scratch(spark, "t"))
    assert [r[0].feature for r in rules] == ["symbol_share", "upper_share"] and all(r[0].above for r in rules)
    wrong = stats.where(quality.verdict(rules) != (F.col("quality") == 1)).count()
    assert wrong <= 6
    assert spark.range(1).select(quality.verdict([]).alias("k")).first().k is True


def test_quality_edge_cases(spark, edge, nothing, labels, no_labels):
    rows, _ = quality.quality(edge, labels)
    assert rows.count() == edge.count()
    assert all(r.base_failed and not r.kept for r in rows.where("n_words < 50").collect())
    assert quality.quality(edge, no_labels)[1] == [] and quality.quality(nothing, labels)[0].count() == 0


def test_pipeline_stages(spark):
    """Each stage on what the one before kept; the last adds tokens; decisions take effect."""
    docs = documents(spark, SF)
    columns, counts, scratch = docs.columns, [docs.count()], Scratch(spark, "p")
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF), name)
        if name != "bpe":
            assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] >= counts[4] == counts[5] > 0.3 * counts[0]
    rows = docs.collect()
    assert all(r.n_chars == len(r.text) and len(r.token_ids) == r.n_tokens for r in rows)
    lines = Counter(x for r in rows for x in r.text.split("\n") if x.strip())
    assert max(lines.values()) == 1
    assert {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()} == \
        {(r.doc_id, r.ids_sha256) for r in rows}


@pytest.mark.parametrize("kind", ["edge", "nothing"])
def test_pipeline_stages_on_edge_cases(spark, request, kind):
    docs, scratch = request.getfixturevalue(kind), Scratch(spark, "p")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF), name)
        assert docs.columns[:len(columns)] == columns
    assert docs.count() <= 13 and (kind == "edge") == (docs.count() > 0)


def test_every_operator_is_registered(spark):
    names = sorted(queries.queries())
    assert [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")] and len(names) == 13
    assert len(corpus_pipeline.STAGES) == 5
