"""BPE (3), secrets (4), personal data (6) and toxicity (9): references, round trips, held-out accuracy, edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from edge_rows import LONG
from pyspark.sql import functions as F

from visitflow.llm import bpe, pii, queries, secrets, toxicity
from visitflow.llm.common import documents, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.whole, special_tokens={})


def odd_texts():
    random.seed(11)
    pool = "abcdefgh theinonerst  \n\n\t'sABC0123456789.,!?éüñß你好🙂"
    out = ["", "   ", "a" * 3000, "aaaa bbbb " * 50, "abab" * 77, "\x1c\x1d\x85 ᠎​ x", "²³¼ ٣٤ 你好 👩‍👩‍👧", "<|endoftext|>",
           "'S'T don't I'LL we'll", " 's x 't", "a  b", "a \n b", "a\n b", "a b ", "a \u3000b\u2003 c", "a\x1c b \x85c", "\u0000\u0001", "ﬁ ª º ⅷ _ __ a_b", "\r\n\r\n  \t x\n\n\n"]
    out += ["".join(random.choice(pool) for _ in range(random.randint(0, 200))) for _ in range(400)]
    out += ["".join(random.choice("aeinrst") for _ in range(300)) for _ in range(100)]
    return out + ["".join(chr(random.choice([random.randrange(1, 0xD7FF), random.randrange(0xE000, 0x1FFFF)]))
                          for _ in range(60)) for _ in range(60)]


def test_encoder_equals_tiktoken(vocabulary, reference):
    texts = odd_texts() + [LONG]
    batches = [pd.Series(texts[i:i + 37]) for i in range(0, len(texts), 37)]
    for size in (1 << 25, 2000):                 # one block, and many that share what came before
        got = [ids for b in bpe.Encoder(vocabulary, size).blocks(batches) for ids in b]
        assert [g.tolist() for g in got] == reference.encode_ordinary_batch(texts)
        assert [bpe.decode_ids(g, vocabulary) for g in got] == [t.encode() for t in texts]


def test_replay_waits_where_a_merge_makes_a_lower_rank():
    """Ranks in which a later merge opens an earlier one, with repeats inside a word."""
    random.seed(7)
    for _ in range(60):
        ranks = {bytes([i]): 1000 + i for i in range(256)}
        parts = {"".join(random.choice("abc") for _ in range(random.randint(2, 5))) for _ in range(14)}
        for r, p in zip(random.sample(range(900), len(parts)), sorted(parts)):
            ranks[p.encode()] = r
        v = bpe.vocabulary(ranks, public_tokenizers.PATTERN)
        words = ["".join(random.choice("abc") for _ in range(random.randint(1, 30))) for _ in range(60)]
        want = []
        for w in words:
            p = [bytes([b]) for b in w.encode()]
            while len(p) > 1:
                best = min(range(len(p) - 1), key=lambda i: (ranks.get(p[i] + p[i + 1], 1 << 30), i))
                if p[best] + p[best + 1] not in ranks:
                    break
                p[best:best + 2] = [p[best] + p[best + 1]]
            want.append([ranks[x] for x in p])
        for few in (0, 12):
            bpe.FEW, old = few, bpe.FEW
            ids, sizes = bpe.replay([w.encode() for w in words], v)
            bpe.FEW = old
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_encode_and_decode_tables(spark, edge, nothing, vocabulary, reference):
    made = bpe.encode(edge.withColumn("n_tokens", F.lit("old")), vocabulary, digests=True)
    rows = bpe.decode(made, vocabulary).collect()
    assert len(rows) == edge.count()
    for r in rows:
        want = reference.encode_ordinary(r.text or "")
        assert r.token_ids == want and r.n_tokens == len(want) and r.decoded == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert r.tokens == "kept tokens"
    assert bpe.encode(nothing, vocabulary).count() == 0


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


def test_scanner_equals_the_patterns():
    random.seed(1)
    scanner = secrets.compile_rules()
    pieces = ["password", "passwd", "PassWord", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA",
              "ABCDEF0123456789ABCD", "0123456789abcdef" * 2, "x", "é", "\n", "==", "secret=", "abcdefgh", "12345678", "🙂"]
    for _ in range(20_000):
        t = "".join(random.choice(pieces) for _ in range(random.randint(0, 25)))
        assert [s for s in scanner.scan(t) if s[1] < 3] == base_secrets(t)
    more = {scanner.kinds[k] for text in ("ghp_" + "Z" * 30, "xoxb-1234567890-abc", "AIza" + "x" * 36, "ASIA" + "9" * 16,
                                          "-----BEGIN RSA PRIVATE KEY-----") for _, k, _ in scanner.scan(text)}
    assert more == {"github", "slack", "google", "temporary", "pem"}


def test_minimal_automaton_accepts_what_the_regex_does():
    random.seed(2)
    for pattern in ("a(b|cd)*e?", "[ab]+c|a?b", "(ab|ba)+", "x*[y-z]"):
        nfa = secrets.Nfa()
        start = nfa.state()
        d = secrets.determinise(nfa, frozenset([start]), {nfa.add(secrets.parse(pattern), start): 0}, False)
        for _ in range(500):
            text = "".join(random.choice("abcdexyz") for _ in range(random.randint(0, 6)))
            s = d.start
            for b in text.encode():
                s = d.table[s * 256 + b]
            assert bool(d.accepts[s]) == bool(re.fullmatch(pattern, text)), (pattern, text)


def test_secret_report_and_mask(spark, edge, nothing):
    docs = spark.createDataFrame([(1, "é token = abcdefgh12 and " + "0" * 32), (2, None), (3, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.span_report(secrets.find_secrets(docs), "secret_spans", secrets.BASE_KINDS).collect()}
    assert rows[1].spans == "assign:2:20,hex:25:57" and (rows[1].n_assign, rows[1].n_access, rows[1].n_hex) == (1, 0, 1)
    assert rows[1].base_sha256 == hashlib.sha256(b"assign:2:20,hex:25:57").hexdigest()
    assert rows[2].spans == rows[3].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs).collect()}
    assert masked == {1: "é [SECRET] and [SECRET]", 2: None, 3: ""}
    assert secrets.find_secrets(edge).count() == edge.count() and secrets.find_secrets(nothing).count() == 0


def base_pii(text):
    out = [(m.start(), 1, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 3, m.end()))
    return sorted(out + [(m.start(), 4, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                         if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15])


def test_base_spans_equal_the_patterns():
    random.seed(1)
    pieces = ["a", "b.c", "@", ".", "..", "x-y", "1", "12", "255", "256", "1.2.3.4", "001.2.3.4", "+1", "+", "(", "555", " ",
              "  ", "-", "555-1234", "4111111111111111", "4111 1111 1111 1111", "é", "\n", "٣", "a@b.c"]
    for _ in range(30_000):
        t = "".join(random.choice(pieces) for _ in range(random.randint(0, 18)))
        assert pii.base_spans(t) == base_pii(t)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_skip_chain_carries_labels_to_distant_repeats(spark):
    """A number without its prefix is ambiguous alone; a repeat of a labelled one is not."""
    rows = [(i, f"call +1 (415) 555-{1000 + i} today. " + "and then some words " * 30 + f"or +1 (415) 555-{1000 + i}")
            for i in range(40)]
    rows += [(100 + i, f"part 555-{5000 + i} of the list " + "and then some words " * 30) for i in range(60)]
    field = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    far = "call +1 (415) 555-7788 today. " + "words between them " * 50 + "then 555-7788 again"
    alone = "then 555-7788 again"
    assert [(k, far[a:b]) for a, k, b in field.spans(far)][-1] == (4, "555-7788")
    assert field.spans(alone) == []
    assert field.spans(None) == [] and field.spans("") == []


def test_every_repeat_in_a_long_document_is_labelled(spark):
    """Fifty repeats of a number that is in full form once: first, in the middle or last."""
    rows = [(i, f"call +1 (415) 555-{1000 + i} today. " + "and then some words " * 30 + f"or +1 (415) 555-{1000 + i}")
            for i in range(40)]
    rows += [(100 + i, f"part 555-{5000 + i} of the list " + "and then some words " * 30) for i in range(60)]
    field = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    full, repeat = "call +1 (415) 555-7788 today. ", "words between them and then 555-7788 again. "
    for before in (0, 25, 50):
        text = repeat * before + full + repeat * (50 - before)
        found = [text[a:b] for a, k, b in field.spans(text) if k == 4]
        assert found.count("555-7788") == 50 and len(found) == 51
    assert field.spans(repeat * 50) == []


def test_the_whole_form_of_a_token_counts():
    head = "a1-" * 150
    assert len({pii.shape(head + end) for end in ("x", "1.2.3.4", "+99", "(5)")}) == 4


def test_personal_data_edge_cases(spark, edge, nothing):
    got = secrets.span_report(pii.find_personal_data(edge), "pii_spans", pii.KINDS)
    assert got.count() == edge.count() and got.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert pii.find_personal_data(nothing).count() == 0


def test_restoration():
    text = " ".join(["the idiot moron and scum of this pathetic trash are worthless clowns or losers"] * 50)
    ids = np.array([toxicity.char_class(c) for c in f" {text} "])
    cost = toxicity.language_model(Counter(((ids[:-2] * 64 + ids[1:-1]) * 64 + ids[2:]).tolist()))
    for token, want in (("1d10t", "idiot"), ("m0r0n", "moron"), ("$cum", "scum"), ("tr@sh", "trash"),
                        ("i.d.i.o.t", "idiot"), ("mooooron", "moron"), ("cl0wns", "clowns")):
        assert toxicity.restore(token, cost) == want
    assert "idiot" in toxicity.words("you i d i o t!", cost, {}) and "moron" in toxicity.words("MORON!!!", cost, {})


def test_joined_long_doubled_and_tailed_tokens_are_restored():
    text = " ".join(["the idiot moron and stupid scum of this total ass house are worthless or you good"] * 50)
    ids = np.array([toxicity.char_class(c) for c in f" {text} "])
    cost = toxicity.language_model(Counter(((ids[:-2] * 64 + ids[1:-1]) * 64 + ids[2:]).tolist()))
    long = ",".join(["house"] * 60 + ["1d10t"] + ["house"] * 60)
    for token, want in (("total-idiot", "idiot"), ("you,1d10t", "idiot"), ("you+1d10t", "idiot"), (long, "idiot"),
                        ("h" * 300 + "/m0r0n", "moron"), ("mooron", "moron"), ("stuupid", "stupid"), ("a$$", "ass"),
                        ("idiot!!!", "idiot"), ("good", "good"), ("i-d-i-o-t", "idiot")):
        assert want in toxicity.words(f"so {token} then", cost, {}), token


def test_disguised_words_are_scored(spark):
    """Trained on plain words, tested on disguised ones."""
    random.seed(3)
    plain = ["house", "river", "stone", "garden", "window", "letter", "morning", "paper", "music", "winter"]

    def clean():
        return " ".join(random.choice(plain) for _ in range(40))
    rows = [(i, f"{clean()} {'idiot' if i % 8 == 0 else ''} {'moron' if i % 8 == 4 else ''} {clean()}") for i in range(400)]
    tests = {1000: "1d10t", 1001: "m0r0n", 1002: "i d i o t", 1003: "", 1004: "h0use"}
    docs = spark.createDataFrame([*rows, *[(i, f"{clean()} {w} {clean()}") for i, w in tests.items()]],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert [got[i].predicted for i in tests] == [1, 1, 1, 0, 0]
    assert all(got[i].predicted == (i % 4 == 0) for i in range(400) if got[i].held_out)


def test_held_out_accuracy(spark):
    """At sf0.1: of 1,300 held-out labels few are wrong, and hardly any clean text is rejected."""
    sf = "/root/testdata/sf0.1"
    got = queries.op9_noisy_channel(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01


def test_held_out_rule(spark):
    rows = documents(spark, SF).select("doc_id", toxicity.held_out().alias("h")).collect()
    import zlib
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def corpus_cost(text):
    ids = np.array([toxicity.char_class(c) for c in f" {text} "])
    return toxicity.language_model(Counter(((ids[:-2] * 64 + ids[1:-1]) * 64 + ids[2:]).tolist()))


def test_viterbi_equals_all_readings():
    """Every reading of short lattices, weighed one by one."""
    cost = corpus_cost("you idiot are a stupid moron good hello trees fool damn ass " * 20)

    def price(reading):
        a = b = 0
        total = 0.0
        for c in reading:
            k = toxicity.char_class(c)
            total += float(cost[a, b, k])
            a, b = b, k
        return total + float(cost[a, b, 0])
    random.seed(9)
    for _ in range(300):
        token = "".join(random.choice("aiodmsst0134$@!*#-|") for _ in range(random.randint(1, 6)))
        options = {}
        for path in itertools.product(*toxicity.lattice(token)):
            text = "".join(r for r, _ in path)
            options[text] = min(options.get(text, math.inf), sum(p for _, p in path) + price(text))
        got = toxicity.restore(token, cost)
        assert options[got] <= min(options.values()) + 1e-4, token


def test_trie_loses_no_scored_word():
    """Scores by the trie of features equal those of every token decoded and every feature looked up."""
    cost = corpus_cost("you idiot are a stupid moron good hello trees fool damn ass " * 20)
    weights = {"^idi": 2.0, "^idiot$": 3.0, "^moron$": 2.5, "^ass$": 1.5, "^dam": 1.2, "^tree": 0.5, "^12$": 1.1}
    model = toxicity.Model(cost, weights, [0.0] * 6)
    random.seed(11)
    tokens = ["1d10t", "m0r0n!!!", "a$$", "ass", "damn", "good-moron", "12", "trees", "treees", "id!ot,", "i_d_i_o_t"]
    tokens += ["".join(random.choice("aidmorontses01$@!-.2") for _ in range(random.randint(1, 8))) for _ in range(2000)]
    hits = 0
    for t in tokens:
        want = {w: max([0.0, *(weights.get(f, 0.0) for f in toxicity.features(w))]) for w in toxicity.readings(t, cost)}
        want = {w: s for w, s in want.items() if s > 0}
        assert model.scored(t) == want, t
        hits += bool(want)
    assert hits > 20


def test_toxicity_edge_cases(spark, edge, nothing, labels, no_labels):
    assert toxicity.toxicity(edge, labels).count() == edge.count()
    kept = toxicity.drop_toxic(edge, no_labels)
    assert kept.columns == edge.columns and kept.count() == edge.count()        # nothing learnt, nothing rejected
    assert toxicity.toxicity(nothing, labels).count() == 0
