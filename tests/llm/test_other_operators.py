"""Media, archives, vectors and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltwork.llm import ann, fixity, mixing, packing, webp

# --- media ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [(1, 1), (7, 9), (13, 6), (16, 17)])
def test_round_trips_through_every_transform(size):
    rng = np.random.default_rng(0)
    h, w = size
    noise = rng.integers(0, 256, (h, w, 4)).astype(np.uint8)
    smooth = (np.add.outer(np.arange(h) * 3, np.arange(w) * 5)[..., None] + rng.integers(0, 4, (h, w, 4))).astype(np.uint8)
    blocks = ((h + 3) // 4, (w + 3) // 4)
    for pixels in (noise, smooth):
        variants = [{}, {"cache_bits": 5}, {"subtract_green": True}, *({"modes": np.full(blocks, m)} for m in range(16))]
        variants.append({"modes": rng.integers(0, 16, blocks), "cross": rng.integers(0, 2**24, blocks).astype(np.uint32) | np.uint32(0xFF000000), "subtract_green": True, "cache_bits": 3})
        for options in variants:
            assert (webp.decode(webp.encode_pixels(pixels, **options)) == pixels).all()


@pytest.mark.parametrize("payload", [b"", b"a", b"ab" * 400, bytes(range(10)) * 200, b"\xff" * 576, b"x" * 5000 + b"y\n" * 3, b"the same line of some length here\n" * 300, bytes(range(256)) * 9])
def test_payloads_come_back(payload):
    padded = webp.padded(payload)
    assert len(padded) % webp.ROW == 0 and len(padded) >= webp.ROW and padded.rstrip(b"\xff") == payload.rstrip(b"\xff")
    assert webp.samples(webp.store(padded)).tobytes() == padded


def transforms(media):
    """The kinds of the transforms of a stored image, from its bits."""
    bits, kinds = webp.Bits(media[20:], 5), []
    while bits.take(1):
        kinds.append(bits.take(2))
        if kinds[-1] == webp.PREDICTOR:
            width = webp.ROW
            shift = bits.take(3) + 2
            webp._decode_pixels(bits, (width + (1 << shift) - 1) >> shift, 1, False)
        elif kinds[-1] == webp.PALETTE:
            break
    return kinds


def test_the_encoder_takes_the_transform_that_needs_the_fewest_bits():
    rng = np.random.default_rng(3)
    ramp = np.arange(20 * webp.ROW).astype(np.uint8).tobytes()
    row = rng.integers(0, 256, webp.ROW).astype(np.uint8)
    above = np.stack([row + np.uint8(3 * k) for k in range(20)]).tobytes()
    text = b"words of some text with more than sixteen letters, " * 60
    kinds = {}
    for name, payload in {"ramp": ramp, "above": above, "text": webp.padded(text), "few": b"abab" * webp.ROW}.items():
        media = webp.store(payload)
        assert webp.samples(media).tobytes() == payload
        kinds[name] = transforms(media)
    assert kinds == {"ramp": [webp.PREDICTOR, webp.SUBTRACT_GREEN], "above": [webp.PREDICTOR, webp.SUBTRACT_GREEN], "text": [webp.SUBTRACT_GREEN], "few": [webp.PALETTE]}
    assert len(webp.store(ramp)) < 1600  # a bit a pixel, where plain samples take eight


def test_long_payloads_take_several_images():
    payload = np.random.default_rng(1).integers(0, 64, 2 * webp.ROW * webp.MAX_ROWS + webp.ROW, dtype=np.uint8).tobytes()
    media = webp.store(payload)
    assert len(list(webp.containers(media))) == 3 and webp.samples(media).tobytes() == payload


def test_repeated_lines_become_references():
    line = "a line of words that is repeated many times over\n"
    assert len(webp.store(webp.padded((line * 200).encode()))) < 800


def test_cut_streams_are_errors():
    data = webp.store(webp.padded(b"some text that is long enough to have codes " * 20))
    with pytest.raises((ValueError, IndexError)):
        webp.decode(data[:12] + b"VP8L" + (10).to_bytes(4, "little") + data[20:30])
    with pytest.raises(ValueError):
        list(webp.containers(b"nothing"))


def test_digest_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (None, "x")], "doc_id long, text string"))
    got = webp.media_digest(docs).toPandas()
    texts = {None if k != k else k: t for k, t in docs.toPandas().itertuples(index=False)}
    assert len(got) == len(texts)
    for row in got.itertuples():
        text = (texts[None if row.doc_id != row.doc_id else row.doc_id] or "").encode()
        payload = webp.padded(text)
        assert (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[got.doc_id.isin([-1, -2])].media_sha256.nunique() == 1


def test_pixels_column(spark):
    docs = spark.createDataFrame([(1, "abc" * 100, "m"), (2, None, "n")], "doc_id long, text string, pixels_of string")
    out = webp.with_pixels(webp.with_media(docs)).collect()
    for row in out:
        pixels = np.frombuffer(row.pixels, np.uint8).reshape(-1, 4)
        assert pixels[:, 0].tobytes() == webp.padded((row.text or "").encode()) and (pixels[:, 3] == 255).all()


# --- archives ---------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_audit_finds_just_what_differs(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (1 + i % 5)) for i in range(0, 9000, 3)]
    other = [(i, u, h if i != 3000 else h + "!") for i, u, h in rows if i != 8001] + [(1, "http://x/1", "new")]
    got = {r.key: r for r in fixity.audit(spark.createDataFrame(rows, PAGES), spark.createDataFrame(other, PAGES)).collect()}
    assert {k: r.kind for k, r in got.items()} == {3000: "corrupt", 8001: "missing", 1: "extra"}
    before = sum(len(fixity_record(r)) for r in rows if r[0] < 3000)
    assert (got[3000].archive, got[3000].offset, got[3000].length) == (0, before, len(fixity_record(rows[1000])))


def fixity_record(row):
    key, url, html = row
    return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: {url}\r\nWARC-Record-ID: <urn:page:{key}>\r\nContent-Type: text/html\r\nContent-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n".encode()


def test_audit_of_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (1, "u", "b"), (2, "u", None), (None, "u", "c"), (5_000_000_000, "far", "away")]
    a = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).withColumn("key", F.lit(2))
    assert fixity.audit(a, a).count() == 0
    once = spark.createDataFrame(rows[1:], PAGES)
    assert [(r.key, r.kind) for r in fixity.audit(a, once).collect()] == [(1, "corrupt")]
    none = a.where("false")
    assert {r.kind for r in fixity.audit(a, none).collect()} == {"missing"} and fixity.audit(none, none).count() == 0


# --- vectors ----------------------------------------------------------------------------------------------------


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    codes[1000:] &= codes[:1] | rng.integers(0, 1 << 16, (2000, 4)).astype(np.uint16) & rng.integers(0, 1 << 16, (2000, 4)).astype(np.uint16)
    index = ann.MultiIndex(codes)
    flat = codes.view(np.uint64)[:, 0]
    for radius in (0, 3, 9, 14, 22, 30, 64):
        for i in (0, 5, 2999):
            assert (index.within(codes[i], radius) == np.flatnonzero(np.bitwise_count(flat ^ flat[i]) <= radius)).all()


def brute_nearest(ids, x, k):
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        other = ids != ids[i]
        s = ann.cosine(x[other], x[i])
        order = np.lexsort((ids[other], -s))[:k]
        out[ids[i]] = list(zip(ids[other][order].tolist(), s[order].tolist(), strict=True))
    return out


def test_recall_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    local = table.toPandas()
    got = ann.nearest(table, shard_rows=100).toPandas()
    want = brute_nearest(local.vec_id.to_numpy(), np.stack(local.embedding).astype("f8"), 5)
    hits = sum(len({v for v, _ in w} & set(got[got.query_id == q].vec_id)) for q, w in want.items())
    assert hits / (5 * len(want)) >= 0.9 and (got.groupby("query_id").size() == 5).all()


def test_each_different_vector_of_an_id_is_a_query(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert len(got) == 4 and got.query_hash.nunique() == 2
    assert sorted(got[got["rank"] == 1].vec_id) == [1, 2]


def test_vectors_of_any_size(spark):
    rows = [(50, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [1e200, 1e199]), (3, [1e-310, 1e-310]), (4, [1.0, 1.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 4, 2, 1] and np.allclose([r.score for r in got], [1, 1, 11 / np.sqrt(202), 0.5**0.5])


def test_recall_on_the_larger_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    local = table.toPandas()
    got = ann.nearest(table).toPandas().groupby("query_id").vec_id.apply(set)
    ids, x = local.vec_id.to_numpy(), ann.unit_rows(np.stack(local.embedding).astype("f8"))
    asked = np.flatnonzero(ids % 50 == 0)
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -2
    best = ids[np.argpartition(-near, 4, 1)[:, :5]]
    assert np.mean([len(got[q] & set(b)) / 5 for q, b in zip(ids[asked], best.tolist(), strict=True)]) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (None, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (8, [1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = ann.nearest(table).orderBy("query_id", "rank").collect()
    of = {q: [(r.vec_id, round(r.score, 6)) for r in got if r.query_id == q] for q in (0, 50, 100)}
    half = round(0.5**0.5, 6)
    assert of[50] == [(1, half), (2, half), (0, 0.0), (0, 0.0), (100, 0.0)]
    assert of[0] == [(100, 1.0), (1, half), (2, half), (50, 0.0)]
    assert of[100] == [(0, 1.0), (0, 1.0), (1, half), (2, half), (50, 0.0)]
    assert ann.nearest(table.where("false")).count() == 0


def test_what_a_search_shuffles_grows_with_the_queries_and_not_with_queries_times_rows(spark):
    """Four times the rows: four times the rows that tasks send, as vectors never leave them; blocks of queries change nothing."""
    rng = np.random.default_rng(3)
    sent, got = [], []
    for n in (1500, 6000):
        rows = [(i, [float(v) for v in rng.normal(size=16)]) for i in range(n)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).cache()
        found = ann.nearest(table, shard_rows=400)
        plan = found._jdf.queryExecution()
        got.append(sorted(map(tuple, found.select("query_id", "rank", "vec_id").collect())))
        in_tasks = [x for x in plan.toString().splitlines() if "MapInArrow" in x]
        assert in_tasks and "FlatMapGroups" not in plan.toString() and "Generate" not in plan.toString()
        sent.append(found.select("query_id").distinct().count() * 5 * 4)
        assert len(got[-1]) == 5 * (n // 50)
        if n == 1500:
            assert sorted(map(tuple, ann.nearest(table, shard_rows=400, block_bytes=1000).select("query_id", "rank", "vec_id").collect())) == got[0]
    assert sent[1] == 4 * sent[0]


# --- the pipeline -----------------------------------------------------------------------------------------------


def test_stages_follow_one_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, at = docs, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns, name
    kept = {r.doc_id for r in at.select("doc_id").collect()}
    assert kept < {r.doc_id for r in before.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept


def test_packed_windows_follow_the_mixing(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = mixing.mixing_schedule(docs).toPandas().sort_values(["slot", "place"])
    mixed = str(tmp_path / "mixed")
    corpus_pipeline.mixing(spark, docs, sf_dir).write.parquet(mixed)
    packed = lambda at: corpus_pipeline.packing(spark, spark.read.parquet(at), sf_dir).toPandas().sort_values(["sequence_id", "offset"])
    got = packed(mixed)
    first = got[got.start == 0]
    for source, rows in placed.groupby("source"):
        assert first[first.source == source].doc_id.tolist() == rows.doc_id.tolist()
    share = mixing.targets(docs)
    window = got[got.sequence_id == 0].groupby("source").length.sum()
    for source, n in window.items():
        assert abs(n - packing.WINDOW * share[source] / sum(share.values())) <= 1
    # Without the stage, or with another schedule, the windows hold other documents.
    other = str(tmp_path / "other")
    docs.orderBy(F.desc("doc_id")).write.parquet(other)
    plain, turned = packed(f"{sf_dir}/documents.parquet"), packed(other)
    key = ["doc_id", "start", "sequence_id", "offset"]
    assert not got[key].reset_index(drop=True).equals(plain[key].reset_index(drop=True))
    assert not plain[key].reset_index(drop=True).equals(turned[key].reset_index(drop=True))


def test_the_whole_pipeline_against_its_parts_by_hand(spark, sf_dir):
    """What run() packs is what plain code makes of the documents that stay: whole, redacted, in windows without gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = {r.doc_id: r.text for r in stages["language_id"](spark, docs, sf_dir).collect()}
    assert len(known) > 0.9 * docs.count() and all((t or "").strip() for t in known.values())
    one = stages["near_dedup"](spark, spark.createDataFrame(list(known.items()), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lang", "source")}), sf_dir)
    kept = {r.doc_id: r.text for r in one.collect()}
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(len(w) - 4, 1))}
    sets = {k: shingles(t) for k, t in kept.items()}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(alike) <= 2  # keys find 97 of 100 pairs at the bound
    clean = {r.doc_id: r.text for r in stages["pii"](spark, docs.where(F.col("doc_id").isin(list(kept))), sf_dir).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    size = {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in clean.items()}
    got = corpus_pipeline.run(spark, sf_dir).toPandas().sort_values(["sequence_id", "offset"])
    assert got.groupby("doc_id").length.sum().to_dict() == size
    for n, rows in got.groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]]
        assert rows.length.sum() == packing.WINDOW or n == got.sequence_id.max()
