"""The training-data operators against brute force on small tables with awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from holdcast.llm import (bpe, chat, common, components, exactdedup, mixing, quality, sharding, simhash, substrings,
                          topk, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, slot int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    make = lambda n: " ".join(rng.choice(words, n))
    long, shared = make(9000), make(70)
    base = [make(int(n)) for n in rng.integers(1, 160, 60)]
    near = base[7] + " " + make(120)
    return [None, "", "  \t\n", "one", "Two words", long, long, *base, base[3], base[3], base[3],
            make(60) + " " + shared + " " + make(20), shared, make(5) + "\n" + shared + "  " + make(70), near, near + " end",
            "don't  STOP now é中 \U0001f600", "<|endoftext|> and <|endoftext|>"]


def _rows():
    texts = _texts()
    order = np.random.default_rng(5).permutation(len(texts))
    rows = [(int(i) * 3, texts[i], "en", [None, "a", "b", "c"][int(i) % 4], 0, "x", 1) for i in order]
    return [*rows, rows[4], rows[4], (None, texts[8], None, None, None, None, None), (None, None, None, "z", None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.prepare(spark)
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _fingerprint(text):
    w = WORD.findall(_lower(text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _groups(items, near):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_op1_against_brute_force(docs, rows, none):
    prints = [_fingerprint(r[1]) for r in rows]
    group = _groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(lambda: None)
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = r[0] if least[g] is None else min(least[g], r[0])
    want = Counter((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group))
    assert _bag(simhash.op1_simhash(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.op1_simhash(none).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    named = {(r[0], least[g]) for r, g in zip(rows, group)}
    assert {r["doc_id"] for r in kept.collect()} == {d for d, c in named if d is None or d == c}


def test_near_dedup_keeps_one_row_of_every_group(spark):
    import corpus_pipeline
    common.prepare(spark)
    near = " ".join(f"a{k}" for k in range(3000))
    rows = [(None, near), (None, near + " x"), (7, near), (7, near + " y"), (7, "some other words"), (9, near),
            (None, "no copies here"), (None, "four more words"), (None, "four more words"), (3, None), (3, "")]
    group = _groups([_fingerprint(t) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    got = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    of = {t: g for (_, t), g in zip(rows, group)}
    assert len(got) == len(set(group)) and {of[r["text"]] for r in got} == set(group)
    assert Counter(r["doc_id"] for r in got) == Counter([7, 7, None, None, 3])


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    fps = []
    for base in rng.integers(0, 2 ** 63, 20, dtype=np.int64):
        for _ in range(int(rng.integers(1, 90))):
            x = int(base)
            for _ in range(int(rng.integers(0, 6))):
                x ^= 1 << int(rng.integers(0, 64))
            fps.append(x)
    fps = np.unique(np.array(fps, np.uint64))
    heads = np.array([0, 1, 3, 70, 200])
    got = {p for i, j in simhash.near_pairs(fps, heads, radius, at_once=500) for p in zip(i.tolist(), j.tolist())}
    ends = [*heads[1:], len(fps)]
    want = {(i, j) for a, b in zip(heads, ends) for i in range(a, b) for j in range(i + 1, b)
            if int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert got == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (5, 4)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 140)}}


def test_op2_against_brute_force(spark):
    common.prepare(spark)
    big = "xé" * 600
    rows = [(1, "http://a/ b\r\nc", big, 1), (5, None, big, 1), (5, "u", big, 2), (3, "u", "small", 1), (4, "u", "small", 1),
            (6, "u", None, 1), (7, "u", "", 1), (None, "u", big, 1), (8, "u", "y" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, offset int")
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        top = max((r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None), default=None)
        again = len(data) >= 1000 and page != top
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert _bag(warc.op2_warc(pages), *names) == Counter(want)
    assert warc.op2_warc(pages.limit(0)).count() == 0


def test_warc_records_and_merged_reads():
    data, digest = warc.record_bytes(9, "http://x", b"<p>\r\n\r\n</p>", None)
    got = warc.parse_record(data)
    assert (got["payload"], got["payload_digest"], got["url"]) == (b"<p>\r\n\r\n</p>", digest, "http://x")
    places = [("a", 0, 10), ("a", 10, 10), ("a", 100, 5), ("b", 0, 4)]
    assert list(warc.merged_reads(places, most=50, gap=0)) == [("a", 0, 20, [0, 1]), ("a", 100, 105, [2]), ("b", 0, 4, [3])]
    assert list(warc.merged_reads(places, most=500, gap=90))[0] == ("a", 0, 105, [0, 1, 2])


def test_op3_law_and_slots(docs, rows, none):
    got = sharding.op3_sharding(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    assert sharding.op3_sharding(none).count() == 0


def test_rebalance_moves_few_slots():
    weight = np.random.default_rng(1).integers(1, 100, 4096).astype(float)
    old = np.arange(4096) * 10 // 4096
    new = sharding.rebalance(old, weight, 11)
    load = np.bincount(new, weights=weight, minlength=11)
    assert load.max() - load.min() < 100
    assert (new != old).mean() < 0.15


def test_large_groups_are_dealt_over_slots(spark):
    rows = [(k, "same" if k % 3 else f"text {k}") for k in range(6000)]
    recs = sharding.records(spark.createDataFrame(rows, "doc_id long, text string"))
    most = sharding.with_virtual_slots(recs).groupBy("virtual_slot").count().agg(F.max("count")).first()[0]
    assert most < 6000 / 100


def test_op3_small_table_with_a_large_group(spark):
    common.prepare(spark)
    rows = [(k, "x" * 100 if k < 100 else f"{k} ".ljust(100)) for k in range(300)]
    got = Counter(r["shard"] for r in sharding.op3_sharding(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len(got) == 40 and max(got.values()) <= 9


def test_op3_keeps_groups_whole_and_does_not_depend_on_layout(spark, monkeypatch):
    common.prepare(spark)
    rng = np.random.default_rng(2)
    rows = [(k, "x" * int(rng.integers(50, 400)) + str(k)) for k in range(4000)]
    rows += [(5000 + k, f"group {k % 30} " * 12) for k in range(600)]              # no group outweighs a shard
    rows += [(None, "much " * 40)] * 900 + [(7, "much " * 40)] * 900               # this one does, several times
    make = lambda n: spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
    keys = ("doc_id", "size", "text_crc32", "shard", "slot")
    got = _bag(sharding.shard(make(3)), *keys)
    monkeypatch.setattr(sharding, "BUCKET", 40)
    monkeypatch.setattr(sharding, "COPIES", 100)
    in_buckets = _bag(sharding.shard(make(11)), *keys)
    assert Counter((k[0], k[2], k[3]) for k in got.elements()) == Counter((k[0], k[2], k[3]) for k in in_buckets.elements())
    for bag in (got, in_buckets):
        places, where, load = defaultdict(list), defaultdict(set), Counter()
        for doc_id, size, crc, shard, slot in bag.elements():
            places[shard].append(slot)
            where[crc].add(shard)
            load[shard] += size
        assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) == 40
        assert [c for c, s in where.items() if len(s) > 1] == [zlib.crc32(b"much " * 40)]
        assert max(load.values()) - min(load.values()) < 0.03 * sum(load.values()) / 40
    monkeypatch.undo()
    assert _bag(sharding.shard(make(7)), *keys) == got


def test_op4_learns_and_handles_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(None, 1, 0), (3, None, 0), (6, 1, 0), (9, 0, 0), (12345, 1, 0), (9, 0, 0)],
                                   "doc_id long, quality int, score int")
    got = quality.op4_quality(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert quality.op4_quality(none, labels).count() == 0
    assert {r["score"] for r in quality.op4_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_op4_fits_one_row_of_a_doc_id_and_all_documents(spark, monkeypatch):
    common.prepare(spark)
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5]
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, quality int")
    docs = spark.createDataFrame([(k, f"text {k} {n}") for k in ids + [1000, None] for n in range(50)],
                                 "doc_id long, text string")
    seen, whole = [], quality.totals
    monkeypatch.setattr(quality, "minimise", lambda p, *a: seen.append(len(p)) or np.zeros(p.shape[1]))
    monkeypatch.setattr(quality, "totals", lambda v, part: seen.append(v.count()) or whole(v, part))
    quality.train(quality.content(docs.repartition(4)), labels)
    good, all_ = sum(k % 2 for k in ids), docs.count()
    assert [seen[0], *seen[2:]] == [all_, all_, good, all_] and 0 < seen[1] < good


def test_op4_unlabelled_documents_teach(spark):
    # Only the texts without a label differ between the two tables; negative labels are never read.
    common.prepare(spark)
    rng = np.random.default_rng(4)
    plain = lambda: " ".join("".join(rng.choice(list("abcde"), 5)) for _ in range(30))
    junk = lambda: "".join(rng.choice(list("#$%0123"), 180))
    good = [(k, plain()) for k in range(400)]
    web = [(1000 + k, junk() if k % 2 else plain()) for k in range(1200)]
    labels = spark.createDataFrame([(k, 1) for k in range(0, 400, 2)], "doc_id long, quality int")
    docs = spark.createDataFrame(good + web, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["predicted"] for r in quality.op4_quality(docs, labels).collect()}
    assert np.mean([got[1000 + k] != k % 2 for k in range(1200)]) > 0.98
    assert np.mean([got[k] for k in range(400)]) > 0.98
    negative = labels.unionByName(spark.createDataFrame([(1000 + k, 0) for k in range(600)], "doc_id long, quality int"))
    assert {r["doc_id"]: r["predicted"] for r in quality.op4_quality(docs, negative).collect()} == got
    moved = quality.op4_quality(docs.filter("doc_id < 1000 or doc_id % 2 = 0"), labels).agg(F.avg("score")).first()[0]
    assert moved > 0.8 > quality.op4_quality(docs, labels).agg(F.avg("score")).first()[0]


def test_op4_fit_on_spark_equals_the_fit_in_memory(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, d, "documents"), common.table(spark, d, "labels")
    vectors = quality.content(docs)
    model = quality.train(vectors, labels)
    again = quality.train(vectors.repartition(13), labels)
    rows = vectors.collect()
    x = quality._matrix(rows)
    taught = {r["doc_id"] for r in labels.filter("quality = 1").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    prior = float(np.mean(model.score(x)))
    brute = quality.fit(x[[r["doc_id"] in taught for r in rows]], x, prior)
    assert np.abs(model.score(x) - brute.score(x)).max() < 0.02
    assert np.abs(model.score(x) - again.score(x)).max() < 1e-4
    assert abs(prior - 0.855) < 0.03      # the share of good documents among the labels, which training does not see


def test_best_bin_finds_the_share():
    p, u = np.zeros(100), np.zeros(100)
    p[80:], u[80:], u[:40] = 50, 600, 700      # 12,000 like the positives, 28,000 that are not
    assert abs(quality.best_bin(p, u) - 0.3) < 0.02
    assert abs(np.average(1 / (1 + np.exp(-((np.arange(100) + 0.5) / quality.BINS - quality.REACH) - quality.shift(u, 0.3))),
                          weights=u) - 0.3) < 1e-6


def test_op4_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, d, "documents"), common.table(spark, d, "labels")
    held = quality.op4_quality(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.op4_quality(docs, labels).filter("predicted = 1").count()


def _brute_repeats(rows):
    first = {}
    split = [WORD.findall(r[1] or "") for r in rows]
    for r, w in zip(rows, split):
        for i in range(len(w) - 49):
            key = tuple(w[i:i + 50])
            if r[0] is not None:
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r, w in zip(rows, split):
        gone = set()
        for i in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[i:i + 50])] < r[0]:
                gone |= set(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_op5_against_brute_force(docs, rows, none):
    want = _brute_repeats(rows)
    assert sum(k[2] > 0 for k in want) > 4
    assert _bag(substrings.op5_substrings(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert substrings.op5_substrings(none).count() == 0


def test_op5_hot_slices_are_answered_in_pieces(spark, docs, rows, tmp_path):
    # Every slice counts as hot; a passage of a third of the rows is one entry of a flush.
    want = _brute_repeats(rows)
    assert _bag(substrings.op5_substrings(docs, most=50), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    passage = " ".join(f"p{k}" for k in range(60))
    hot = [(k, passage if k % 3 else f"x{k} " * 60) for k in range(900)]
    df = spark.createDataFrame(hot, "doc_id long, text string").repartition(4)
    packed = substrings.anchors(df, 3).collect()
    for row in packed:
        ids = substrings.unpack(row["ids"], np.int64)[substrings._from_planes(row["docs"], np.uint16)]
        hashes = substrings.unpack(row["hashes"], np.uint32).astype(np.uint64)
        reduced = substrings._least(hashes, hashes, ids, ids, np.ones(len(ids), np.uint8))
        assert len(reduced[0]) == len(set(hashes.tolist()))
    assert _bag(substrings.op5_substrings(df, most=500), "doc_id", "n_words", "n_removed", "kept_sha256") == _brute_repeats(hot)


def test_packed_arrays_round_trip():
    values = np.sort(np.random.default_rng(2).integers(0, 2 ** 32, 1000).astype(np.uint32))
    assert (substrings.unpack(substrings.pack(values), np.uint32) == values).all()


def _brute_exact(rows):
    ids = defaultdict(list)
    for r in rows:
        ids[r[1] or ""].append(r[0])
    top = {t: max((i for i in v if i is not None), default=None) for t, v in ids.items()}
    return ids, top


@pytest.mark.parametrize("weak", [False, True])
def test_op6_against_brute_force(docs, rows, weak):
    ids, top = _brute_exact(rows)
    # A weak digest must not change groups: hits are checked on full bytes.
    digest = (lambda t: F.substring(t, 1, 1)) if weak else exactdedup.sha256_of
    got = exactdedup.exact_duplicates(docs, digest).select(
        "row.doc_id", F.col("stays.doc_id").alias("keep_id"), "n", (F.col("row") == F.col("stays")).alias("kept")).collect()
    want = Counter((r[0], top[r[1] or ""], len(ids[r[1] or ""])) for r in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["n"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(ids)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_op6_empty_and_kept_rows(docs, rows, none):
    assert exactdedup.op6_exact_dedup(none).count() == 0
    kept = exactdedup.keep_one(docs)
    ids, top = _brute_exact(rows)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.collect()) == Counter((top[t], t) for t in ids)


def test_op6_stream_goes_on_where_it_stopped(spark, tmp_path):
    stream = exactdedup.DedupStream(spark, f"file://{tmp_path}/stream")
    common.prepare(spark)
    assert stream.groups().count() == 0
    for ids in ([1, 2], [7, 3]):
        rows = spark.createDataFrame([("d", (i, "f", i)) for i in ids] + [(f"own {ids[0]}", (0, "f", 0))], exactdedup.SLIM)
        stream.add(rows)
        stream.advance()
    got = {r["digest"]: (r["n"], r["stays"]["doc_id"]) for r in stream.groups().collect()}
    assert got == {"d": (4, 7), "own 1": (1, 0), "own 7": (1, 0)}


def test_op7_against_the_library(docs, rows, none):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.tokenizer_path())
    want = []
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert _bag(bpe.op7_bpe(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(want)
    assert bpe.op7_bpe(none).count() == 0


def test_backtracking_equals_replayed_merges():
    enc, rng = bpe.encoder(bpe.tokenizer_path()), np.random.default_rng(4)
    for alphabet in (b"aehinorst", b"ab", bytes(range(256)), b" \n="):
        for n in rng.integers(1, 60, 150):
            data = bytes(rng.choice(list(alphabet), n).tolist())
            assert enc.word(data) == enc.v.replay(data)
            assert bpe.decode(enc.v, np.array(enc.word(data), np.uint32)) == data


def test_op8_recovers_roles(spark):
    common.prepare(spark)
    conv = common.table(spark, "/root/testdata/sf0.01", "conversations")
    lines = chat.parse(conv).collect()
    true = {(str(r["conv_id"]), r["turn"]): r["role"] for r in conv.collect()}
    right = [chat.ROLES[r["state"] // 2] == true[r["conv"], r["turn"]] for r in lines]
    assert np.mean(right) > 0.9
    turns = chat.op8_chat(conv).collect()
    assert len({(r["conv_id"], r["turn_no"]) for r in turns}) == len(turns)
    assert sum(r["n_lines"] for r in turns) == len(lines)


def test_op8_awkward_rows_and_long_transcripts(spark):
    common.prepare(spark)
    rows = [(1, t, ["user", "assistant"][t % 2], f"line {t}" + "\nmore" * (t % 3), 1) for t in range(200)]
    rows += [(2, 5, "user", f"text {k}", 1) for k in range(1500)] + [(2, 5, "user", "text 1", 1)]
    rows += [(None, None, None, None, 1), (3, -4, "tool", "", 1), (3, 0, "user", "x" * 100_000, 1)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, state int")
    found = chat.parse(conv).collect()
    whole = defaultdict(list)
    for r in found:
        whole[r["conv"]].append(r)
    assert len({(r["block_turn"], r["block_part"]) for r in whole["2"]}) > 3 and len(whole["2"]) == 1500
    got = chat.render(chat.parse(conv)).collect()
    assert {r["conv_id"] for r in got} == {1, 2, 3, None}
    assert chat.op8_chat(conv.limit(0)).count() == 0


def test_op8_learns_from_gaps_ties_and_block_borders(spark):
    common.prepare(spark)
    rows = [(1, t * 10, ["user", "assistant"][t % 2], f"a {t}") for t in range(30)]
    rows += [(2, 5, ["user", "system"][k % 2], f"b {k}") for k in range(1500)] + [(2, 9, None, "c"), (2, 12, "user", "d")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.with_blocks(chat.turns(conv)).filter("role is not null").withColumn("last", F.lit(0))
    want = Counter()
    ordered = sorted(((r["conv"], r["turn"], r["order"], r["role"]) for r in found.collect()))
    for a, b in zip(ordered, ordered[1:]):
        if a[0] == b[0]:
            want[2 * chat.ROLES.index(a[3]), b[3]] += 1
    assert sum(want.values()) == 29 + 1500
    assert Counter((r["end"], r["next"]) for r in chat.moves(found).collect()) == want


def test_blocks_give_the_viterbi_path():
    rng = np.random.default_rng(6)
    move = np.log(rng.dirichlet(np.ones(chat.START), chat.START + 1))
    model = chat.Hmm(move, np.log(rng.dirichlet(np.ones(chat.SYMBOLS), chat.START)))
    symbols = rng.integers(0, chat.SYMBOLS, 300)
    whole = chat.path(model, symbols)
    parts = np.split(symbols, [1, 40, 41, 170])
    ends = chat.borders(np.stack([chat.fold(model, p) for p in parts]))
    assert np.concatenate([chat.path(model, p, *e) for p, e in zip(parts, ends)]).tolist() == whole.tolist()


def test_borders_in_levels_and_turns_in_pieces(spark):
    common.prepare(spark)
    rng = np.random.default_rng(8)
    blocks = [(conv, t * 64, 0, rng.normal(0, 5, (chat.START + 1, chat.START))) for conv, n in (("1", 70), ("2", 3)) for t in range(n)]
    folded = spark.createDataFrame([(*b[:3], b[3].reshape(-1).tolist()) for b in blocks],
                                   "conv string, block_turn bigint, block_part bigint, matrix array<double>").repartition(3)
    got = {(r["conv"], r["block_turn"]): (r["entry"], r["leave"]) for r in chat.all_borders(folded, fan=4).collect()}
    for conv in ("1", "2"):
        own = [b for b in blocks if b[0] == conv]
        assert [got[b[:2]] for b in own] == chat.borders(np.stack([b[3] for b in own]))
    found = [("5", 64 * (k // 50), 0, k, k, 0, f"  line {k} ", 2 if k == 0 else 3, 1) for k in range(300)]
    found += [("6", 0, 0, 1, 1, 0, "short", 2, 1)]
    lines = spark.createDataFrame(found, "conv string, block_turn bigint, block_part bigint, turn bigint, order bigint, "
                                         "place int, line string, state int, turn_no bigint").repartition(3)
    key = lambda rows: sorted((r["conv_id"], r["piece"], r["rendered"], r["n_lines"], r["role"], r["at_turn"]) for r in rows)
    whole, pieces = key(chat.render(lines).collect()), key(chat.render(lines, piece_bytes=200).collect())
    assert len(whole) == 2 and len(pieces) > 10 and max(len(p[2]) for p in pieces) < 300
    assert "".join(p[2] for p in pieces if p[0] == 5) == whole[0][2] and pieces[-1] == whole[1]
    assert sum(p[3] for p in pieces) == 301 and {p[4:] for p in pieces if p[0] == 5} == {whole[0][4:]}


def test_op9_against_brute_force(spark):
    common.prepare(spark)
    rng = np.random.default_rng(7)
    vecs = [[float(np.float32(x)) for x in rng.normal(0, 0.3, 8)] for _ in range(300)]
    rows = [(k, vecs[k % 250] if k < 280 else vecs[0], k) for k in range(300)]
    rows += [(1000, None, 0), (1001, [None] * 8, 0), (1100, [math.nan] * 8, 0), (1200, [math.inf] * 8, 0), (None, vecs[1], 0),
             (200, vecs[200], 200), (1300, [0.5, 0.5], 0), (1301, [0.25, -1.0], 0), (1302, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)
    ints = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = Counter()
    for q in [i for i in ints if i % 100 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:10]))
    assert _bag(topk.op9_topk(df), "query_id", "rank", "vec_id", "score") == want
    assert topk.op9_topk(df.limit(0)).count() == 0


def test_op9_scores_of_large_components_are_exact(spark):
    common.prepare(spark)
    # 2 ** 42 in integers: beyond 31 bits, and scores beyond 2 ** 53 that differ by 1 and beyond 2 ** 63.
    rows = [(0, [2.0 ** 32, 2.0 ** -10]), (100, [2.0 ** 45, 0.0])] + [(k, [2.0 ** 8, k / 1024]) for k in range(1, 15)]
    rows += [(k, [2.0 ** 22, 0.0]) for k in range(20, 23)] + [(30, [2.0 ** 45, 1.0])]
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    want = Counter()
    for q in (0, 100):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        want.update((q, n + 1, i, min(-s, 2 ** 63 - 1)) for n, (s, i) in enumerate(scored[:10]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert _bag(topk.op9_topk(df), "query_id", "rank", "vec_id", "score") == want


def test_op10_targets_and_limits(docs, rows, none):
    got = mixing.op10_mixing(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = mixing.fill(np.array([sizes[s] for s in names]), mixing.weights(len(names)), float(sum(sizes.values())))
    assert {(r["source_size"], round(r["target"], 6)) for r in got} == {
        (sizes[s], round(t, 6)) for s, t in zip(names, goal.tolist())}
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source_size"]] += r["taken"]
    assert all(abs(taken[sizes[s]] - t) < 1 for s, t in zip(names, goal))
    again = mixing.op10_mixing(docs.repartition(5)).collect()
    assert Counter(got) == Counter(again)
    assert mixing.op10_mixing(none).count() == 0


def test_op10_rows_hold_the_words_taken(docs):
    taken = sum(r["taken"] for r in mixing.op10_mixing(docs).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(WORD.findall(r["text"])) for r in out.collect()) == taken


def test_fill_reshares_the_excess():
    got = mixing.fill(np.array([10, 1000, 0]), np.array([1.0, 2.0, 3.0]), 1010.0)
    assert got.tolist() == [30.0, 980.0, 0.0]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutation_is_one(n):
    at = mixing.permute(np.arange(n), n, 5, np.full(n, 2))
    assert sorted(at.tolist()) == list(range(n))
    assert (mixing.permute(at, n, 5, np.full(n, 2), inverse=True) == np.arange(n)).all()


def test_draw_meets_the_quotas():
    quota = np.array([0, 5, 1000, 37])
    assert (sum(mixing.draw(quota, 16)) == quota).all()


def test_slices_cut_long_batches():
    texts = ["a" * 10, "", "b" * 1000, "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(common.slices(iter([batch]), 0, limit=20))
    assert [p.num_rows for p, _, _ in parts] == [2, 1, 1]
    assert b"".join(d.tobytes() for _, d, _ in parts) == "".join(texts).encode()


def test_slots_are_listed_by_many_tasks(spark):
    shares = [mixing.share_of(0, 256 * 300_000, 256 * 300_000.0), mixing.share_of(1, 1000, 500.0)]
    listed = mixing.slots(spark, shares)
    assert listed.rdd.getNumPartitions() == mixing.slot_tasks(300_002) == 5
    got = {r["source_no"]: (r["n"], r["blocks"], r["words"]) for r in listed.groupBy("source_no").agg(
        F.count("*").alias("n"), F.countDistinct("block").alias("blocks"), F.sum("words").alias("words")).collect()}
    assert got == {0: (300_000, 300_000, 256 * 300_000), 1: (2, 2, 500)}
    assert mixing.slot_tasks(1 << 60) == mixing.MOST_TASKS


def test_archives_are_read_by_tasks_counted_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "STRETCH", 1000)
    index = spark.createDataFrame([("a", 500 * i, 500) for i in range(100)], "file string, offset bigint, length bigint")
    assert warc.read_records(index, "/nowhere").rdd.getNumPartitions() == 50


def test_hit_bitmap_keeps_every_hit(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    hits = rows.filter("id % 50 = 7")
    got = {r["id"] for r in exactdedup.possible_hits(rows, hits.select("digest")).collect()}
    assert set(range(7, 5000, 50)) <= got and len(got) < 110
    assert exactdedup.possible_hits(rows, hits.select("digest"), bits=1 << 15).columns == rows.columns
    assert exactdedup.possible_hits(rows, hits.limit(0)).count() == 0


def test_encoder_does_not_remember_long_pre_tokens():
    encoder = bpe.Encoder(bpe.encoder(bpe.tokenizer_path()).v)
    word = "".join(chr(97 + i * i % 26) for i in range(5000))
    assert (encoder.encode(f"{word} and {word}") == encoder.encode(f"{word} and {word}")).all()
    assert encoder.memory and max(map(len, encoder.memory)) <= bpe.REMEMBERED


def test_quality_scores_with_the_features_it_was_fitted_on():
    rng = np.random.default_rng(8)
    positive, unlabelled = rng.normal(1, 1, (50, quality.FEATURES)), rng.normal(0, 1, (200, quality.FEATURES))
    model = quality.fit(positive, unlabelled, 0.3, steps=20)
    far = unlabelled[:5] + 1e6 * np.sign(rng.normal(size=(5, quality.FEATURES)))
    at_border = model.centre + model.scale * quality.CLIP * np.sign(far - model.centre)
    assert np.allclose(model.score(far), model.score(at_border))
    seen = np.c_[quality.standardised(unlabelled, model.centre, model.scale), np.ones(200)] @ np.r_[model.weight, model.bias]
    assert np.allclose(model.score(unlabelled), 1 / (1 + np.exp(-seen)))
