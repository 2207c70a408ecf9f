"""Operators on documents, pages and vectors against brute force."""

import gzip
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from chatloom.llm import jaccard, language, mixing, neighbours, packing, quality, warc
from chatloom.llm.queries import LLM_QUERIES
from chatloom.llm.words import pieces, shingle_set, word_hashes

from .conftest import SMALL

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_of(docs):
    """Smallest id that links reach, by comparing every pair."""
    sets, label = {i: shingles_of(t) for i, t in docs}, {i: i for i, _ in docs}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    label[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_op6_equals_all_pairs(spark, documents, odd, no_documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = LLM_QUERIES["op6_signature_trees"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_of(docs)
    named = odd.filter("doc_id is not null")
    rows = jaccard.link_groups(named).collect()
    assert len(rows) == named.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_of([(r.doc_id, r.text) for r in named.dropDuplicates().collect()])
    assert jaccard.link_groups(odd).count() == odd.count()
    assert jaccard.link_groups(no_documents).count() == 0


def test_op6_links_chains_and_borderline_pairs(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[: 60 - k] + [f"x{j}" for j in range(k)])) for k in range(20)]
    rows += [(100 + k, " ".join(["the same passage of words"] * 9 + [f"own{k}-{j}" for j in range(30)])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_groups(docs, common_from=3).collect()}
    assert got == components_of(rows)


def test_tree_pairs_in_pages_lose_no_pair(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(1, 1 << 62, 40).astype(np.uint64)) for _ in range(12)]
    sets += [np.unique(np.concatenate([s[2:], rng.integers(1, 1 << 62, 2).astype(np.uint64)])) for s in sets]
    rows = [(1, len(sets), k, k, len(s), jaccard.signature(s).tobytes()) for k, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "shingle long, size long, class long, component long, n long, sig binary")
    for page in (5, 100):
        got = {(r.a, r.b) for r in jaccard.tree_pairs(members, page).collect()}
        assert {(k, k + 12) for k in range(12)} <= got


def test_hashes_do_not_depend_on_pieces():
    text = ("Ab\tcd  é\n" * 400).encode()
    assert b"".join(pieces(text, 37)) == text
    assert word_hashes(text).tolist() == word_hashes("ab CD é " * 400).tolist()
    assert len(shingle_set("a b c d e a b c d e a b c d e")) == 5 and len(shingle_set("a b")) == 1


def features_of(text):
    w = SPLIT.findall(text or "")
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in (text or "").split("\n") if SPLIT.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_op8_counts_and_verdicts(spark, documents, odd, no_documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = LLM_QUERIES["op8_quality_votes"](spark, SMALL).collect()
    assert {r.doc_id: tuple(r[c] for c in quality.BASE) for r in rows} == {i: features_of(t) for i, t in texts.items()}
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    labels = {r.doc_id: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    labelled = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(bool(a) == b for a, b in labelled) >= 0.95 * len(labelled)
    got = Counter((r.doc_id, *(r[c] for c in quality.BASE)) for r in quality.score_quality(odd).collect())
    assert got == Counter((r.doc_id, *features_of(r.text)) for r in odd.collect())
    assert quality.score_quality(no_documents).count() == 0
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and quality.keep_good(no_documents).count() == 0


def test_op8_em_finds_accurate_rules(spark):
    n = len(quality.RULES)
    rows = [tuple([1] + [0] * (n - 1) + [90]), tuple([0, -1, -1] + [0] * (n - 3) + [10]), tuple([1, 0, 0, -1] + [0] * (n - 4) + [5])]
    model = quality.fit(spark.createDataFrame(rows, ", ".join(f"{r} int" for r in quality.RULES) + ", n long"))
    assert model.accuracy["prose"] > 0.9 and model.accuracy["symbols"] > 0.85 and model.accuracy[quality.RULES[3]] < 0.75


def test_op3_held_out_accuracy_and_undetermined(spark, odd, no_documents):
    rows = LLM_QUERIES["op3_language_codes"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(truth)
    found = language.identify(odd).collect()
    assert len(found) == odd.count()
    letters = Counter((r.doc_id, any(map(str.isalpha, r.text or ""))) for r in odd.collect())
    assert Counter((r.doc_id, r.lang_pred != "und") for r in found) == letters
    assert language.identify(no_documents).count() == 0
    assert language.keep_identified(odd).columns == odd.columns
    words = language.codewords(4)
    assert min((a != b).sum() for k, a in enumerate(words) for b in words[:k]) >= 5


def test_op4_records_and_revisits(spark, tmp_path):
    long = "<p>é</p>" * 9000
    html = [long, None, "", "short", "short", long, "x" * 100, "x" * 100, "x" * 99]
    rows = [(k, None if k == 3 else f"http://a b/{k}\r\n", h, "x") for k, h in enumerate(html)] + [(None, "u", "y" * 200, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes string")
    folder = str(tmp_path / "warc")
    manifest = warc.write_archives(warc.chunk_table(warc.records(pages), size=1000), folder)
    got = {r.page_id: tuple(r)[1:] for r in warc.read_archives(manifest).collect()}
    first = {}
    for page_id, _, text, _ in rows:
        data = (text or "").encode()
        at = first.setdefault(data, page_id) if len(data) >= 100 else page_id
        kind = ("revisit", at) if at != page_id else ("response", None)
        assert got[page_id] == (len(data), hashlib.sha256(data).hexdigest(), *kind)
    for r in manifest.collect():
        with open(r.file, "rb") as f:
            back = {h["warc-record-id"]: b"".join(c) for h, c in warc.read_records(f, 777)}
        assert gzip.open(r.file).read(10) == b"WARC/1.1\r\n" and len(back) == r.n_records
        if "<urn:page:0>" in back:
            assert back["<urn:page:0>"].decode() == long
    assert warc.archive_and_read(pages.limit(0)).count() == 0
    assert LLM_QUERIES["op4_warc_chunks"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()


def test_op5_base_scores_and_a_proper_model(spark, documents, odd, no_documents):
    docs = {r.doc_id: r.text for r in documents.collect()}
    crc = __import__("zlib").crc32
    held = {i: crc(str(i).encode()) % 5 == 1 for i in docs}
    counts = Counter(w for i, t in docs.items() if not held[i] for w in [*words_of(t), "\n"])
    total, kinds = sum(counts.values()), len(counts)
    rows = LLM_QUERIES["op5_context_mixing"](spark, SMALL).collect()
    for r in rows:
        tokens = [*words_of(docs[r.doc_id]), "\n"]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens), total)
        assert r.n_known == sum(w in counts for w in tokens)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert mixing.score_texts(odd).count() == odd.count()
    assert mixing.score_texts(no_documents).count() == 0


def test_op5_probabilities_of_next_bytes_sum_to_one():
    trees = mixing.code_trees(np.random.default_rng(1).random((256, 256)) * 9)
    tables = [np.random.default_rng(k).normal(0, 2, 1 << b).astype(np.float32) for k, b in enumerate(mixing.TABLE_BITS)]
    mixer = mixing.Mixer(trees, tables, mixing.MixState())
    total = 0.0
    for symbol in range(256):
        block = np.frombuffer(b"\x00\x00 ab" + bytes([symbol]), np.uint8)
        total += math.exp(mixer._block(block, mixing.MixState(), 0))
    assert abs(total - 1) < 1e-3


@pytest.mark.parametrize("text", ["", "a", "Ab  c\n", "word " * 9000, "x" * 40_000])
def test_op5_streams_hold_the_canonical_text(text):
    blocks = list(mixing.stream_of(text))
    assert b"".join(b[5:].tobytes() for b in blocks) == " ".join(words_of(text)).encode() + b"\n"


def test_op10_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 24))
    x = (centres[rng.integers(30, size=3000)] + rng.normal(size=(3000, 24)) * 0.4).astype(np.float32)
    x[100:1100] = x[7]  # a third of the rows are one vector
    rows = [(k, [float(v) for v in x[k]], "c") for k in range(3000)]
    rows += [(4000, None, "c"), (4020, [0.0] * 24, "c"), (4040, [float("nan")] * 24, "c"), (4060, [1.0, None] * 12, "c"), rows[40]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = defaultdict(list)
    for r in neighbours.nearest(vectors, cell_size=200, sample_size=500).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    wide, hits, total = x.astype(float), 0, 0
    assert set(found) == set(range(0, 3000, 20))
    for q, got in found.items():
        score = (wide * wide[q]).sum(1)
        assert all(math.isclose(s, score[v], rel_tol=1e-12) for v, s in got) and len(got) == 20
        score[q] = -np.inf
        want = np.lexsort((np.arange(3000), -score))[:20]
        hits += len(set(want) & {v for v, _ in got})
        total += 20
    assert hits / total >= 0.95
    assert neighbours.nearest(vectors.limit(0)).count() == 0
    few = neighbours.nearest(vectors.filter("vec_id < 5")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few)] == [(0, k) for k in range(1, 5)]


def test_pipeline_stages(spark, documents):
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and after.items() <= before.items()
        if name == "near_duplicates":
            groups = components_of([(i, r.text) for i, r in before.items()])
            assert set(after) == {c for _, c in groups.values()}
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(after)
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()
    assert packing.pack(packed.select("doc_id", "length").limit(0)).count() == 0


def test_a_short_text_is_learned_along():
    trees = mixing.code_trees(np.ones((256, 256)))
    tables = [np.random.default_rng(k).normal(0, 2, 1 << b).astype(np.float32) for k, b in enumerate(mixing.TABLE_BITS)]
    mixer = mixing.Mixer(trees, tables, mixing.MixState())
    text = "one short text of few words " * 60
    once, _ = mixer.log_probability(text)
    unlearned = sum(mixer.log_probability(text[at : at + 112])[0] for at in range(0, len(text), 112))
    assert len(text) < 2000 and once > unlearned + 10


def test_texts_side_by_side_score_as_one_by_one_in_fewer_calls(monkeypatch):
    rng = np.random.default_rng(5)
    trees = mixing.code_trees(rng.random((256, 256)))
    tables = [rng.normal(0, 1, 1 << b).astype(np.float32) for b in mixing.TABLE_BITS]
    start = mixing.MixState(hits=rng.random(mixing.GATES * mixing.BUCKETS), seen=rng.random(mixing.GATES * mixing.BUCKETS) + 1)
    mixer = mixing.Mixer(trees, tables, start)
    words = ["one", "two", "Ünd", "x" * 40, "#!"]
    texts = ["", " \n", "z" * 40_000, "long one " * 9000, *(" ".join(rng.choice(words, n)) for n in rng.integers(1, 400, 120))]
    alone = [mixer.log_probability(text) for text in texts]
    calls, step = [], mixing.Mixer._step
    monkeypatch.setattr(mixing.Mixer, "_step", lambda self, *rest: calls.append(1) or step(self, *rest))
    together = mixer.log_probabilities(iter(texts))
    assert [n for _, n in together] == [n for _, n in alone]
    assert np.allclose([p for p, _ in together], [p for p, _ in alone], rtol=1e-9, atol=0)
    fewer, calls[:] = len(calls), []
    for text in texts[4:]:
        mixer.log_probability(text)
    # The two long texts alone take some 400 steps one after the other; the short ones ride along.
    assert len(calls) > 500 and fewer < len(calls)
    assert mixer.log_probabilities([]) == [] and (mixer.start.seen >= 1).all() and len(mixer.start.weights) == mixing.GATES


def test_bits_counted_by_unit_are_all_counted(monkeypatch):
    monkeypatch.setattr(mixing, "UNITS", 1500)
    monkeypatch.setattr(mixing, "TOGETHER", 500)
    rng = np.random.default_rng(6)
    trees = mixing.code_trees(rng.random((256, 256)))
    words = np.array(["a", "bcd", "ÿé", "longer", "!", "q" * 30])
    texts = ["", *(" ".join(rng.choice(words, n)) for n in (1, 3, 40, 150)), *(rng.bytes(300).hex() for _ in range(8))]
    counts, want = mixing.BitCounts(trees), [np.zeros(2 << b, np.int64) for b in mixing.TABLE_BITS]
    calls, slots = [], mixing.slots
    for text in texts * 3:
        for block in mixing.stream_of(text):
            places, bit, _, _ = slots(trees, *mixing.contexts([block])[:2])
            for table, p in zip(want, places):
                table += np.bincount(p * np.uint32(2) + bit, minlength=len(table))
    monkeypatch.setattr(mixing, "slots", lambda trees, tail, prefix: calls.append(len(tail)) or slots(trees, tail, prefix))
    for text in texts * 3:
        for block in mixing.stream_of(text):
            counts.add(block)
    assert all((a == b).all() for a, b in zip(counts.finish(), want))
    assert len(calls) > 1 and max(calls) < 1500
    calls.clear()
    often = mixing.BitCounts(trees)
    for _ in range(50):
        for block in mixing.stream_of("the same words again and again " * 5):
            often.add(block)
    often.finish()
    assert sum(calls) < 200  # of 7,750 bytes


def test_tree_pairs_are_fewer_than_members_and_meet_by_wide_maps(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(1, 1 << 62, 2000).astype(np.uint64)
    alike = [np.unique(np.concatenate([base[k:], rng.integers(1, 1 << 62, k).astype(np.uint64)])) for k in range(12)]
    apart = [np.unique(rng.integers(1, 1 << 62, 2000).astype(np.uint64)) for _ in range(12)]
    rows = [
        (1, 24, k, k, len(s), jaccard.signature(s).tobytes(), jaccard.wide_signature(s).tobytes()) for k, s in enumerate(alike + apart)
    ]
    schema = "shingle long, size long, class long, component long, n long, sig binary, wide binary"
    members = spark.createDataFrame(rows, schema)
    every = {(r.a, r.b) for r in jaccard.tree_pairs(members).collect()}
    assert every == {(a, b) for b in range(12) for a in range(b)}
    few = {(r.a, r.b) for r in jaccard.tree_pairs(members, trees_only=True).collect()}
    assert len(few) == 11 and few <= every


def test_op5_learns_from_every_training_text(spark, monkeypatch):
    """Long texts and all others are in the code trees, in the bit tables and in the starting weights."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.bytes(6).hex() for _ in range(60)) for _ in range(39)] + [" ".join(rng.bytes(5).hex().upper() for _ in range(3000)), None]
    seen, learned_start, code_trees = {}, mixing.learned_start, mixing.code_trees

    def kept(name, f):
        def g(*args):
            seen[name] = args, f(*args)
            return seen[name][1]
        return g

    monkeypatch.setattr(mixing, "code_trees", kept("trees", code_trees))
    monkeypatch.setattr(mixing, "_tables", kept("tables", mixing._tables))
    monkeypatch.setattr(mixing, "learned_start", lambda lessons: learned_start(kept("lessons", lessons)))
    docs = spark.createDataFrame([(None, t) for t in texts] * 2, "doc_id long, text string").repartition(3)
    scored = mixing.score_texts(docs).collect()
    trees, pairs = seen["trees"][1], np.zeros((256, 256))
    tables = [np.zeros((1 << b, 2)) for b in mixing.TABLE_BITS]
    for text in texts:
        for block in mixing.stream_of(text or ""):
            np.add.at(pairs, (block[4:-1], block[5:]), 2)
            places, bit, _, _ = mixing.slots(trees, *mixing.contexts([block])[:2])
            for table, p in zip(tables, places):
                np.add.at(table, (p, bit), 2)
    assert np.allclose(seen["trees"][0][0], pairs + pairs.sum(0) / pairs.sum())
    for table, counts in zip(seen["tables"][1][2], tables):
        assert (table == np.log((counts[:, 1] + 0.3) / (counts[:, 0] + 0.3)).astype(np.float16)).all()
    assert seen["lessons"][1].seen.sum() == tables[0].sum()  # every bit of every text
    words = [r for r in scored if r.n_tokens == 61]
    assert len(words) == 78 and max(r.bits_per_byte for r in words) < 2 * min(r.bits_per_byte for r in words)
    assert max(r.bits_per_byte for r in scored if r.n_tokens == 3001) < 2


def test_starting_weights_are_those_of_the_least_loss():
    rng = np.random.default_rng(9)
    trees = mixing.code_trees(np.ones((256, 256)))
    tables = [rng.normal(0, 1, 1 << b).astype(np.float32) for b in mixing.TABLE_BITS]
    blocks = [b for _ in range(40) for b in mixing.stream_of(rng.bytes(400).hex(" ", 3))]
    tail, prefix, _ = mixing.contexts(blocks)

    def lessons(weights):
        total = mixing.Lessons()
        total.add(trees, tables, weights, (tail, prefix, np.ones(len(tail), np.uint32)))
        return total

    start = mixing.learned_start(lessons)
    least = lessons(start.weights).loss.sum()
    assert least < lessons(np.full_like(start.weights, 0.3)).loss.sum() - 10
    for k in range(4):
        for move in (-0.2, 0.2):
            weights = start.weights.copy()
            weights[:, k] += move
            assert lessons(weights).loss.sum() > least
