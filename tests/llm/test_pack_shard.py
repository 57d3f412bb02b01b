"""Sharding, packing and token counts: brute force, round trips and bounds; the pipeline against its stages."""


import importlib.util
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recheck.llm import packing, sharding, token_counts, tokens

LIBRARY = None


def library_ids(text):
    """Ids by the tokenizer library on the whole text."""
    global LIBRARY
    if LIBRARY is None:
        from tokenizers import Tokenizer
        LIBRARY = Tokenizer.from_file(tokens.tokenizer_path())
        LIBRARY.encode_special_tokens = True
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(weird_rows):
    odd = ["", " ", "\n", "a", " a", "a ", "a\n\nb", "a \n b", "\na", "a b", "x" * 300, "a  b", "I'll don't WE'RE 12 3.5,b",
           "a　b", "<|endoftext|> x", "é é́.", "日本 語。", "a\tb c\r\nd", "..", "a.. b,, c.", "½ ² x²"]
    texts = odd + [t or "" for _, t, *_ in weird_rows]
    for dtype in ("<u2", "<u4"):
        got = tokens.Encoder(dtype=dtype).ids(texts)
        assert [np.frombuffer(g, dtype).tolist() for g in got] == [library_ids(t) for t in texts]


def test_ids_are_the_untouched_librarys(weird_rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.tokenizer_path())
    texts = ["<|endoftext|>", "a <|endoftext|>", "a<|endoftext|>b c", "<|endoftext|> x\ny <|endoftext|><|endoftext|>",
             "<|endoftext", " <|EndOfText|>", "", *[t or "" for _, t, *_ in weird_rows]]
    got = [np.frombuffer(g, "<u4").tolist() for g in tokens.Encoder(special=True).ids(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [50256] != library_ids(texts[0])


def test_queries_pack_the_untouched_librarys_ids(spark, docs_frame, tmp_path):
    import corpus_pipeline
    from recheck.llm.queries import QUERIES
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.tokenizer_path())
    rows = [(1, "one <|endoftext|> two", "en", "s"), (2, "plain text", "en", "s")]
    docs_frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t, *_ in rows}
    for got in (QUERIES["op4_packing"](spark, str(tmp_path)), corpus_pipeline.packed(spark, docs_frame(rows), "")):
        assert {r.doc_id: r.length for r in got.collect()} == want


def test_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 10)
    e = tokens.Encoder()
    for k in range(5):
        t = " ".join(f"word{k}x{j}" for j in range(20))
        assert np.frombuffer(e.ids([t])[0], "<u4").tolist() == library_ids(t)
        assert len(e.after) <= 20 + 10 + 1


def test_shards(weird, weird_rows, empty):
    got = sharding.shards(weird, 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in weird_rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = defaultdict(set)
    for r in got:
        where[(r["size"], r.text_crc32)].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert sharding.shards(empty, 8).count() == 0


def test_shards_are_near_equal(docs_frame):
    rnd = random.Random(3)
    rows = [(i, "x" * int(rnd.lognormvariate(5, 1)), "en", "s") for i in range(1200)]
    for bundles in (sharding.BUNDLES, 300):
        got = sharding.shards(docs_frame(rows), 8, bundles=bundles).groupBy("shard").sum("size").collect()
        sums = [r[1] for r in got]
        assert len(sums) == 8 and max(sums) - min(sums) <= 0.01 * sum(sums) / 8


def test_differencing_parts():
    rnd = random.Random(1)
    for n in (0, 1, 7, 8, 9, 500):
        sizes = [rnd.randint(1, 10**6) for _ in range(n)]
        part = sharding.differencing(sizes, 8)
        assert len(part) == n and all(0 <= p < 8 for p in part)
        if n == 8:
            assert sorted(part) == list(range(8))
    greedy = lambda s, k: max(sum(x) for x in [[sum(sorted(s)[i::k])] for i in range(k)])
    sums = [0] * 8
    for s, p in zip(sizes, part):
        sums[p] += s
    assert max(sums) - min(sums) < 2000 and max(sums) <= greedy(sizes, 8)


def slow_pieces(rows, capacity=2048):
    out = Counter()
    for i, t, *_ in rows:
        ids = library_ids(t) + [0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def test_packing(weird, weird_rows, empty):
    got = packing.pack(weird).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == slow_pieces(weird_rows)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack(empty).count() == 0


def check_sequences(rows, capacity):
    inside = defaultdict(list)
    for s, at, n in rows:
        inside[s].append((at, n))
    for parts in inside.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity


def test_sequences_round_trip(weird, weird_rows):
    packed = packing.pack(weird, ids=True, capacity=64).cache()
    assert max(r.length for r in packed.collect()) <= 64
    parts = {(r.sequence_id, r.offset): bytes(r.ids) for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        at = 0
        for n in r.lengths:
            assert bytes(r.ids)[4 * at: 4 * (at + n)] == parts.pop((r.sequence_id, at))
            at += n
        assert len(r.ids) == 4 * at <= 256
    assert not parts


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 2049, 3000), rng.integers(600, 2049, 3000), rng.integers(300, 1100, 3000),
               np.clip(rng.lognormal(6, 1.2, 4000).astype(int), 1, 2048), np.full(50, 700), np.zeros(0, int)][seed]
    hist = dict(Counter(lengths.tolist()))
    runs = packing.plan(hist)
    held = Counter()
    for n, inside in runs:
        assert n > 0 and sum(a * b for a, b in inside) <= 2048
        for a, b in inside:
            held[a] += n * b
    assert held == Counter(hist)
    plain = packing.Open(2048)
    for length in sorted(hist, reverse=True):
        plain.fit(length, hist[length])
    assert sum(n for n, _ in runs) <= sum(n for x in plain.runs.values() for n, _ in x)
    table = packing.slots(runs)
    assert len(table) == len({(r[0], r[1]) for r in table.tolist()})


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_large_pieces_come_from_configurations(spark, monkeypatch, sf):
    """Nine of ten large pieces at least are placed by the program, in no more sequences than best fit takes without any
    grouping."""
    parts = packing.pieces(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"), special=True)
    hist = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}
    taken, real = [], packing.configured
    monkeypatch.setattr(packing, "configured", lambda *a: taken.append(real(*a)) or taken[-1])
    runs = packing.plan(hist)
    large = sum(n for k, n in hist.items() if 512 < k < 2048)
    assert sum(taken) >= 0.9 * large and taken[-1] == 0
    plain = packing.Open(2048)
    for length in sorted(hist, reverse=True):
        plain.fit(length, hist[length])
    assert sum(n for n, _ in runs) <= sum(n for x in plain.runs.values() for n, _ in x)


@pytest.mark.parametrize("seed", range(4))
def test_dearest_combination_equals_all_tried(seed):
    from itertools import combinations_with_replacement
    rng = np.random.default_rng(seed)
    sizes = np.array(sorted(set(rng.integers(26, 100, 12).tolist()), reverse=True))
    worth = rng.random(len(sizes)) * rng.integers(0, 2, len(sizes))
    best, used = packing.dearest(sizes, worth, 100)
    worths = [(sum(worth[list(c)]), 100 - sizes[list(c)].sum()) for k in (1, 2, 3)
              for c in combinations_with_replacement(range(len(sizes)), k)]
    less = lambda room: packing.LOSS if 0 < room < 12 else 0
    assert best == pytest.approx(max(w - less(room) for w, room in worths if room >= 0))
    assert used @ sizes <= 100 and best == pytest.approx(used @ worth - less(100 - used @ sizes))


def test_program_equals_all_combinations():
    """On few sizes: no whole solution is below the program's value, and the program's solution covers what is needed."""
    sizes, need = [70, 55, 45, 30], [5, 7, 8, 9]
    used = packing.combinations(sizes, need, 100)
    assert all(x >= -1e-9 and c @ np.array(sizes) <= 100 for x, c in used)
    assert np.allclose(sum(x * c for x, c in used), need)
    value = sum(x for x, _ in used)
    # 70+30 five times, 55+45 seven times, then 45, 30, 30, 30, 30 in two
    assert value <= 14 and value >= sum(s * n for s, n in zip(sizes, need)) / 100
    assert sum(n for n, _ in packing.plan(dict(zip(sizes, need)), 100)) == 14


def test_groups_have_equal_cardinality():
    rng = np.random.default_rng(0)
    hist = dict(Counter(rng.integers(300, 2000, 5000).tolist()))
    out = packing.grouped(hist, 50)
    assert all(max(v for v, _ in m) == s for s, m in out)
    assert sum(n for _, m in out for _, n in m) == 5000 and {sum(n for _, n in m) for _, m in out[:-1]} == {100}


def test_token_counts(weird, weird_rows, empty):
    want = Counter(len(library_ids(t)) for _, t, *_ in weird_rows)
    got = token_counts.of_documents(weird).collect()
    assert Counter(r.n_tokens for r in got) == want and all(r.complete for r in got)
    by_file = defaultdict(list)
    for r in got:
        by_file[r.file].append((r.doc_no, r.start, r.n_tokens))
    for rows in by_file.values():
        at = 0
        for k, (no, start, n) in enumerate(sorted(rows)):
            assert (no, start) == (k, at)
            at += n + 1
    assert token_counts.of_documents(empty).count() == 0


@pytest.mark.parametrize("block, file_bytes", [(7, 1 << 28), (1 << 16, 1 << 28), (5, 10), (1, 10)])
def test_scan_of_flat_files(spark, tmp_path, block, file_bytes):
    """Documents across blocks, empty documents, an open end, an empty file; small and large files."""
    rng = np.random.default_rng(8)
    want = {}
    for name, end in (("a", True), ("b", False), ("c", True)):
        docs = [rng.integers(0, 999, int(n)).tolist() for n in (0, 0, 40, 1, 3, 0, 64, 7)]
        flat = [t for d in docs for t in [*d, 999]]
        if not end:
            flat = flat[:-1]
        np.array(flat, "<u2").tofile(tmp_path / name)
        want[name] = [(len(d), end or k < len(docs) - 1) for k, d in enumerate(docs)]
    (tmp_path / "empty").write_bytes(b"")
    got = defaultdict(list)
    for r in token_counts.counts(spark, str(tmp_path), 999, "<u2", block, file_bytes).orderBy("file", "doc_no").collect():
        got[r.file.rsplit("/", 1)[1]].append((r.n_tokens, r.complete))
    assert dict(got) == want


@pytest.mark.parametrize("n, tail", [(10007, b""), (10007, b"x"), (10000, b"x"), (1, b"x"), (0, b"x")])
def test_large_files_have_the_blocks_of_small_ones(spark, tmp_path, n, tail):
    """A prime number of ids and a part of an id at the end, whatever the size from which on a file is large."""
    ids = np.random.default_rng(n).integers(0, 40, n).astype("<u2")
    (tmp_path / "a b%20c").write_bytes(ids.tobytes() + tail)
    ends = np.flatnonzero(ids == 7)
    lengths = [*np.diff([-1, *ends]) - 1, *([n - 1 - ends[-1]] if len(ends) and ends[-1] < n - 1 else [])]
    lengths = lengths if len(ends) else [n] * (n > 0)
    for file_bytes in (1 << 28, 3000, 0):
        blocks = token_counts.block_ends(spark, str(tmp_path), 7, "<u2", 256, file_bytes)
        assert [(r.block, r.n) for r in blocks.orderBy("block").collect()] == [
            (k, min(256, n - at)) for k, at in enumerate(range(0, n, 256))]
        got = token_counts.stitched(blocks).orderBy("doc_no").collect()
        assert [r.n_tokens for r in got] == lengths


@pytest.mark.parametrize("n, tail", [(10007, b""), (10000, b"x")])
def test_large_files_that_only_spark_reads(spark, tmp_path, n, tail):
    ids = np.random.default_rng(n).integers(0, 40, n).astype("<u2")
    ids[-1] = 7
    (tmp_path / "a").write_bytes(ids.tobytes() + tail)
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.flat{n}.link./in", f"file://{tmp_path}")
    got = token_counts.counts(spark, f"viewfs://flat{n}/in", 7, "<u2", 256, 3000).orderBy("doc_no").collect()
    assert [r.n_tokens for r in got] == (np.diff([-1, *np.flatnonzero(ids == 7)]) - 1).tolist()


@pytest.mark.parametrize("file_bytes", [1 << 28, 3000])
def test_no_file_is_read_whole(spark, tmp_path, file_bytes):
    """Files in file: come a block at a time, whatever their size: Spark may not even hold the contents of one."""
    ids = np.random.default_rng(3).integers(0, 40, 20011).astype("<u2")
    for name in "ab":
        (tmp_path / name).write_bytes(ids.tobytes() + b"x")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        blocks = token_counts.block_ends(spark, str(tmp_path), 7, "<u2", 256, file_bytes).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    for name in "ab":
        of_file = sorted((r.block, r.n, r.ends) for r in blocks if r.file.endswith(f"/{name}"))
        assert of_file == [(k, min(256, len(ids) - at), np.flatnonzero(ids[at: at + 256] == 7).tolist())
                           for k, at in enumerate(range(0, len(ids), 256))]


def test_files_that_only_spark_reads_are_cut_before_python(spark, tmp_path):
    """A row a block, none with more than a block's bytes; the part of an id at a file's end is left out."""
    sizes = {"none": 0, "half": 1, "one": 2, "block": 512, "odd": 1025, "last": 1538}
    data = {name: np.random.default_rng(n).bytes(n) for name, n in sizes.items()}
    for name, x in data.items():
        (tmp_path / name).write_bytes(x)
    got = token_counts.cut(spark.read.format("binaryFile").load(str(tmp_path)), 512, 2).collect()
    assert sorted((f.rsplit("/", 1)[1], k, bytes(x)) for f, k, x in got) == sorted(
        (name, k, x[at: min(at + 512, len(x) // 2 * 2)]) for name, x in data.items()
        for k, at in enumerate(range(0, len(x) // 2 * 2, 512)))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.cut.link./in", f"file://{tmp_path}")
    blocks = token_counts.block_ends(spark, "viewfs://cut/in", 7, "<u2", 256)
    assert sorted((r.file.rsplit("/", 1)[1], r.block, r.n) for r in blocks.collect()) == sorted(
        (name, k, min(256, n // 2 - at)) for name, n in sizes.items() for k, at in enumerate(range(0, n // 2, 256)))


def test_files_in_pieces_count_as_one(spark, weird, tmp_path, monkeypatch):
    """In stores that only Spark reads files are written in pieces; counts are those of whole files."""
    docs = weird.coalesce(2).localCheckpoint()

    def counted():
        got = token_counts.of_documents(docs).collect()
        return sorted((re.search(r"part-(\d+)", r.file)[1], *r[1:]) for r in got), len({r.file for r in got})

    want = counted()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pieces.link./in", f"file://{tmp_path}")
    monkeypatch.setattr(token_counts, "ensure_checkpoint_dir", lambda _: "viewfs://pieces/in")
    assert counted() == want
    token_counts.write_flat(docs, f"file://{tmp_path}/kept", piece_rows=3)
    assert len(list((tmp_path / "kept").glob("part-*"))) > 4
    monkeypatch.setattr(token_counts, "PIECE_ROWS", 3)
    assert counted() == want and want[1] == 2


def test_blocks_come_in_bounded_batches():
    ends = np.arange(token_counts.BATCH_ENDS // 4, dtype=np.int32)
    full = [b.num_rows for b in token_counts.batched(("f", k, len(ends), ends) for k in range(10))]
    few = [b.num_rows for b in token_counts.batched(("f", k, 9, ends[:1]) for k in range(2 * token_counts.BATCH + 1))]
    assert full == [4, 4, 2] and few == [token_counts.BATCH, token_counts.BATCH, 1]
    assert list(token_counts.batched(iter(()))) == []


def test_documents_of_one_file_are_made_in_many_tasks(spark):
    """The scan over a file's blocks carries no end ids, and the documents are not made where it runs."""
    rows = [("f", k, 64, list(range(k % 3, 64, 3))) for k in range(400)]
    blocks = spark.createDataFrame(rows, "file string, block bigint, n bigint, ends array<int>").localCheckpoint()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = token_counts.stitched(blocks).withColumn("pid", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ends = [64 * k + e for _, k, _, inside in rows for e in inside]
    assert sorted((r.doc_no, r.start, r.n_tokens) for r in got if r.complete) == [
        (i, b + 1, e - b - 1) for i, (b, e) in enumerate(zip([-1, *ends], ends))]
    by_task = Counter(r.pid for r in got)
    assert max(by_task.values()) < len(got) / 2


def test_written_files_are_flat(spark, docs_frame, tmp_path):
    rows = [(i, t, "en", "s") for i, t in enumerate(["a b", "", None, "É 你好 <|endoftext|>", "x " * 300])]
    token_counts.write_flat(docs_frame(rows).coalesce(1), str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert np.frombuffer(data, "<u2").tolist() == [x for _, t, *_ in rows for x in [*library_ids(t), 50256]]


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline(spark, weird, docs_frame, empty, tmp_path):
    import corpus_pipeline
    from recheck.llm import exact_dedup, mixing, quality_rules, simhash

    weird.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect())
    left = mixing.mix(simhash.dedup(exact_dedup.dedup(quality_rules.keep(weird))))
    assert got == slow_pieces([(r.doc_id, r.text) for r in left.collect()]) and got
    docs = weird
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == weird.columns
        docs = out
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def survivors(rows):
    """(stage, documents that stay) of the first three stages, in plain Python."""
    from test_dedup import before, lowered, slow_fingerprint, slow_labels
    from test_rules_mixing import slow_kept
    rows = [r for r in rows if slow_kept(r[1])]
    yield "quality_rules", rows
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r)
    rows = [max(g, key=lambda r: before(r[0])) for g in groups.values()]
    yield "exact_dedup", rows
    parts = defaultdict(list)
    for r, c in zip(rows, slow_labels([slow_fingerprint(t) for _, t, *_ in rows]).tolist()):
        parts[c].append(r)
    yield "simhash_dedup", [min(p, key=lambda r: (r[0] is None, r[0] or 0)) for p in parts.values()]


def check_stages(spark, stages, docs, rows, folder):
    """Each stage's Parquet against plain Python on what must have reached it."""
    from test_rules_mixing import size_of, slow_targets
    out = {}
    for k, (name, stage) in enumerate(stages):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out[name] = docs.collect()
    for name, left in survivors(rows):
        assert Counter((r.doc_id, r.text, r.lang, r.source) for r in out[name]) == Counter(left), name
    copies = Counter((r.doc_id, r.text, r.lang, r.source) for r in out["mixing"])
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in left:
        sizes[r[3]] += size_of(r[1])
        taken[r[3]] += size_of(r[1]) * copies[r]
        largest[r[3]] = max(largest[r[3]], size_of(r[1]))
    goal = slow_targets(dict(sizes))
    assert all(abs(taken[s] - goal[s]) <= 3 * largest[s] for s in sizes)
    got = out["packing"]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == slow_pieces(copies.elements())
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 2048) + 1
    return [len(x) for x in out.values()]


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_stages_against_plain_python(spark, docs_frame, weird_rows, tmp_path):
    import corpus_pipeline
    rows = weird_rows + [(300 + i, t.capitalize() if i < 15 else t + " tail", lang, src) for i, t, lang, src in weird_rows[:50]]
    n = check_stages(spark, corpus_pipeline.STAGES, docs_frame(rows), rows, str(tmp_path / "a"))
    assert len(rows) > n[0] > n[1] > n[2] > 10
    # a document that a stage loses is seen
    lost = max(i for i, *_ in dict(survivors(rows))["simhash_dedup"] if i is not None)
    stages = [(k, f if k != "exact_dedup" else lambda s, d, p, f=f: f(s, d, p).where(F.col("doc_id").isNull() | (F.col("doc_id") != lost)))
              for k, f in corpus_pipeline.STAGES]
    with pytest.raises(AssertionError):
        check_stages(spark, stages, docs_frame(rows), rows, str(tmp_path / "b"))
