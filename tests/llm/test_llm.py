import hashlib
import io
import math
import re
import tracemalloc
import zipfile
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import decontaminate, jaccard, mixing, ppm, quality, queries, secrets, sharding, topk, toxicity, warc
from touchline.llm.components import components

SF = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def tokens(t):
    return re.findall("[^\x20\x09-\x0d]+", low(t))


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# 1


def test_ppm_equals_a_recursive_model(spark):
    docs, order = read(spark, "documents").limit(60), 3
    rows = texts(docs)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    count, follow = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    for i, t in rows:
        if i not in held:
            count.update([*tokens(t), "END"])
            q = b"\n" * order + ppm.coded(t.encode())
            for j in range(order, len(q)):
                for k in range(order + 1):
                    follow[k][q[j - k : j]][q[j]] += 1

    def log_p(context, b):
        gone, p = set(), 1.0
        for k in range(order, -1, -1):
            seen = {x: n for x, n in follow[k].get(context[len(context) - k :], {}).items() if x not in gone}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if b in seen:
                return math.log10(p * seen[b] / total)
            p *= len(seen) / total
            gone |= set(seen)
        return math.log10(p / (256 - len(gone)))

    n, v = sum(count.values()), len(count)
    for most in (10_000, 400):  # one block, several blocks
        for r in ppm.report(docs, order, most).collect():
            t = dict(rows)[r.doc_id]
            own = [*tokens(t), "END"]
            q = b"\n" * order + ppm.coded(t.encode())
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in held, len(own), sum(count[w] > 0 for w in own), n)
            assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
            assert r.score == pytest.approx(sum(log_p(q[j - order : j], q[j]) for j in range(order, len(q))), rel=1e-9)


def test_a_block_of_the_ppm_model_fits_two_workers_of_an_executor():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 48, ppm.BLOCK_GRAMS, dtype=np.uint64))
    tracemalloc.start()
    try:
        ppm.ByteModel(keys, np.ones(len(keys), np.int64), ppm._distinct(keys & np.uint64(0xFFFF), np.ones(len(keys), np.int64)))
        assert tracemalloc.get_traced_memory()[1] < 400e6  # random grams share no contexts: over twice what as many of texts take
    finally:
        tracemalloc.stop()


def test_ppm_chunks_of_a_stored_model_ask_for_rare_grams_only(spark):
    docs = read(spark, "documents").limit(60).selectExpr("doc_id", "text", "false AS _held").coalesce(1)
    grams = ppm.settle(ppm.count_grams(docs.select(docs.text.cast("binary").alias("text"))), "grams")
    stored = ppm.model_of(grams, most=4000)
    chunks = ppm.pack_chunks(docs, stored).collect()
    asked = np.concatenate([ppm._loosened(bytes(c.rare), np.uint64) for c in chunks])
    distinct = np.unique(np.concatenate([ppm.gram_keys([t.encode()])[0] for _, t in texts(docs.drop("_held"))]))
    kept = stored.frequent(distinct) <= 0
    assert len(chunks) == 1 and 0 < kept.sum() <= 4000
    assert sorted(asked.tolist()) == distinct[~kept].tolist()
    whole = ppm.model_of(grams, most=1 << 30)
    assert stored.frequent(distinct[kept]).tolist() == whole.log10(distinct[kept]).tolist()


# 2


def test_warc_round_trip_and_revisits(spark):
    long, tie = "y" * 120, "z" * 99
    pages = spark.createDataFrame([(5, "http://a/ b", long), (3, None, long), (3, "u", long), (None, "u", long), (7, "u", None), (8, "u", ""), (9, "u", tie), (1, "u", tie)], "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()), key=str)
    want = [(5, 120, "revisit", 3), (3, 120, "response", None), (3, 120, "response", None), (0, 120, "revisit", 3), (7, 0, "response", None), (8, 0, "response", None), (9, 99, "response", None), (1, 99, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_span_files_and_keep_payloads(spark):
    pages = read(spark, "pages").coalesce(1)
    folder = warc.fresh_path(spark, "t")
    listed = warc.write_archives(pages, folder, records=20)
    assert listed.count() == 3
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(listed).collect()}
    assert got == {r.page_id: r.html.encode() for r in pages.collect()}


def test_zip_reader_reads_zip64_and_rejects_damage():
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as m:
            m.write(b"0123456789")
        z.writestr("b/ü", b"xyz")
        z.comment = b"PK\x05\x06 in a comment"
    data = held.getvalue()
    r = warc.ZipReader(io.BytesIO(data), len(data))
    assert r.read("a", 3, 4) == b"3456" and r.read("b/ü") == b"xyz"
    with pytest.raises(ValueError):
        r.read("a", 8, 4)
    with pytest.raises(ValueError):
        warc.ZipReader(io.BytesIO(data[:40]), 40)
    # A ZIP64 end record, as archives of many members have.
    n, size, start = 2, len(data) - 22 - len(z.comment) - data.index(b"PK\x01\x02"), data.index(b"PK\x01\x02")
    at = start + size
    end = b"PK\x06\x06" + (44).to_bytes(8, "little") + bytes(12) + n.to_bytes(8, "little") * 2 + size.to_bytes(8, "little") + start.to_bytes(8, "little")
    tail = b"PK\x06\x07" + bytes(4) + at.to_bytes(8, "little") + (1).to_bytes(4, "little") + b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + bytes(2)
    whole = data[:at] + end + tail
    assert warc.ZipReader(io.BytesIO(whole), len(whole)).read("a") == b"0123456789"


# 3


def test_shards_hold_all_rows_in_tiers(spark, edge):
    docs = read(spark, "documents").repartition(5)
    store = sharding.shard(docs, arrival=20_000, target=200_000)
    assert store.read(docs.schema).drop("_shard").exceptAll(docs).count() == 0 and store.read(docs.schema).count() == docs.count()
    sizes = [r.bytes for r in store.manifest().collect()]
    assert len(sizes) < len(store.manifest(1).collect()) and max(sizes) < 800_000
    before = store.versions()[-1]
    assert store.append(docs.limit(3)) == before + 1 and store.read(docs.schema).count() == docs.count() + 3
    assert store.read(docs.schema, before).count() == docs.count()
    assert store.commit(store.manifest(), before) is None  # the version is taken
    assert sorted(r.shard for r in store.read(docs.schema, columns=["doc_id"], shard_column="shard").select("shard").distinct().collect()) == sorted(r.shard for r in store.manifest().collect())
    assert sorted(map(str, sharding.shard(edge).read(edge.schema).drop("_shard").collect())) == sorted(map(str, edge.collect()))
    assert sharding.report(docs.limit(0)).count() == 0


def test_shard_report_equals_its_files(spark):
    import pyarrow.parquet as pq

    docs = read(spark, "documents").repartition(4)
    folder = sharding.fresh_path(spark, "t")
    store = sharding.shard(docs, folder, arrival=20_000, target=200_000)
    size = {r.shard: (r.rows, r.bytes, r.tier) for r in store.manifest().collect()}
    own = {}
    for shard, (rows, held, tier) in size.items():
        t = pq.read_table(f"{folder.removeprefix('file://')}/shards/{shard}")
        assert t.num_rows == rows and tier == (math.floor(math.log(max(held / 20_000, 1), 4)))
        for i, text in zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True):
            own.setdefault((i, len((text or "").encode()), shard), 0)
            own[i, len((text or "").encode()), shard] += 1
    got = Counter((r.doc_id, r.n_bytes, r.shard) for r in store.read(docs.schema).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"), F.col("_shard").alias("shard")).collect())
    assert got == own and {r.doc_id for r in docs.collect()} == {k[0] for k in own}
    report = sharding.report(docs, arrival=20_000, target=200_000).toPandas()
    assert report.groupby("shard").agg(n=("doc_id", "size"), rows=("shard_rows", "first")).eval("n == rows").all()
    assert set(report.version) == {max(store.versions())} and sorted(report.n_bytes) == sorted(k[1] for k, n in own.items() for _ in range(n))
    assert (report.tier == np.floor(np.log(np.maximum(report.shard_bytes / 20_000, 1)) / math.log(4)).astype(int)).all()


def test_vacuum_spares_writers_and_listed_versions(spark, monkeypatch):
    docs = read(spark, "documents").repartition(4)
    store = sharding.shard(docs, arrival=20_000, target=200_000)
    n, versions = docs.count(), sorted(store.versions())
    assert store.vacuum(least_age=0) == 0 and all(store.read(docs.schema, v).count() == n for v in versions)
    plain = store.commit
    told = {}

    def interrupted(shards, after):  # between the writing of the shards and their commit, another run cleans up
        if not told:
            told["expired"] = sharding.ShardStore(spark, store.folder).expire()
            told["gone"] = sharding.ShardStore(spark, store.folder).vacuum(least_age=0)
        return plain(shards, after)

    monkeypatch.setattr(store, "commit", interrupted)
    store.append(docs)
    assert told["expired"] == versions[:-1] and told["gone"] > 0
    assert store.read(docs.schema).count() == 2 * n and store.read(docs.schema, versions[-1]).count() == n
    assert store.vacuum(least_age=3600) == 0
    with pytest.raises(ValueError):
        store.read(docs.schema, shard_column="text")


# 4


def test_secrets_equal_plain_patterns(spark, edge):
    assign = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    docs = read(spark, "documents").select("doc_id", "text").unionByName(edge.select(F.col("doc_id") + 10_000_000, "text").toDF("doc_id", "text"))
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    for i, t in texts(docs):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert [sum(s[1] == k for s in spans) for k in range(3)] == [got[i].n_assign, got[i].n_access, got[i].n_hex]
        assert got[i].base_sha256 == hashlib.sha256(secrets.written(spans).encode()).hexdigest()
        assert {x for x in secrets.written(spans).split(",") if x} <= set(got[i].spans.split(","))


def test_random_strings_but_no_digests_or_identifiers():
    encode = secrets.encoding(secrets.load_ranks()).encode_ordinary
    find = lambda t: [t[a:b] for a, _, b in secrets.random_spans(t, encode)]
    assert find("key kJ8sd9Q2mXz71LpRtB4v here") == ["kJ8sd9Q2mXz71LpRtB4v"]
    assert find("qxzvkjwpbtmfghrdyncl and QxZvKjWpBtMfGhRd") == ["qxzvkjwpbtmfghrdyncl", "QxZvKjWpBtMfGhRd"]
    rng, letters = np.random.default_rng(3), list("abcdefghijklmnopqrstuvwxyz")
    assert sum(bool(find("".join(rng.choice(letters, 24)))) for _ in range(300)) > 290
    assert not find("internationalization getElementByIdAndClassName AbstractSingletonProxyFactoryBean erteachlichschheit part-12-of-a-34-part-b")
    assert not find("d41d8cd98f00b204e9800998ecf8427e 123e4567-e89b-12d3-a456-426614174000 my_long_identifier_name_v2 4111111111111111111111")


# 5


def test_top_k_equals_sorting(spark):
    e = read(spark, "embeddings").select("vec_id", "embedding")
    odd = spark.createDataFrame([(1_000_000, None), (1_000_001, [None] * 64), (1_000_002, [float("nan")] * 64), (1_000_100, [0.5] * 3), (None, [0.1] * 64)], "vec_id long, embedding array<float>")
    same = e.filter("vec_id = 100").withColumn("vec_id", F.col("vec_id") + F.lit(2_000_000)).unionByName(e.filter("vec_id = 100").withColumn("vec_id", F.col("vec_id") + F.lit(2_000_001)))
    both = e.unionByName(same).unionByName(odd)
    p = e.unionByName(same).toPandas()
    x, ids = np.floor(1024 * np.array([np.array(v, float) for v in p.embedding])).astype(int), p.vec_id.to_numpy()
    for block in (1024, 2):
        got = topk.top_k(both, F.col("vec_id") % 100 == 0, 10, block).toPandas()
        for k in np.flatnonzero(ids % 100 == 0):
            s = x @ x[k]
            best = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[k]][:10]
            g = got[got.query_id == ids[k]].sort_values("rank")
            assert list(zip(g.vec_id, g.score)) == list(zip(ids[best], s[best]))
    huge = spark.createDataFrame([(0, [1e18, 0.0], "x"), (1, [1e18, 1.0], "x"), (2, [-1e18, 5.0], "x"), (3, [1e-3, 3e15], "x"), (4, [0.0, 2.0], "x"), (4, [0.0, 2.0], "x"), (5, [1e306, 0.0], "x")], "vec_id long, embedding array<double>, block string")
    exact = {i: [math.floor(1024 * c) for c in x] for i, x in ((0, (10**18, 0)), (1, (10**18, 1)), (2, (-(10**18), 5)), (3, (1e-3, 3 * 10**15)), (4, (0, 2)))}
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(huge, F.col("vec_id") < 5, 10).collect()}
    for q, x in exact.items():
        held = sorted(((-max(min(sum(a * b for a, b in zip(x, y)), 2**63 - 1), -(2**63)), i) for i, y in [*exact.items(), (4, exact[4])] if i != q))
        assert [got[q, k + 1] for k in range(len(held))] == [(i, -s) for s, i in held]
    few = topk.top_k(e.filter("vec_id < 4"), F.col("vec_id") == 0, 10).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert topk.top_k(e.limit(0), F.lit(True)).count() == 0


# 6


def test_mixing_equals_its_sql(spark, edge, tmp_path):
    edge.write.parquet(str(tmp_path / "e"))
    for docs, path in ((read(spark, "documents"), f"{SF}/documents.parquet"), (edge, f"{tmp_path}/e/*.parquet")):
        c = duckdb.connect()
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
        want = sorted(map(str, c.sql(mixing.mixing_sql()).fetchall()))
        assert sorted(str(tuple(r)) for r in mixing.report(docs).collect()) == want


def test_mix_comes_near_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.report(docs).withColumn("source", F.lit(0)).toPandas()
    rows["source"] = docs.select("doc_id", "source").toPandas().set_index("doc_id").loc[rows["doc_id"], "source"].to_numpy()
    per = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    off = (per.taken / per.target - 1).abs()
    assert off.max() < 0.1 and (rows.taken <= 3 * rows["size"]).all()


def test_mix_keeps_limits_and_columns(spark, edge):
    m = mixing.mix(edge)
    assert m.filter("_copies > 3 OR _taken > 3 * _size").count() == 0
    out = mixing.emit(m)
    assert out.columns == edge.columns and out.count() == m.agg(F.sum("_copies")).first()[0]
    assert mixing.emit(mixing.mix(edge.limit(0))).count() == 0


# 7 and 9


@pytest.mark.parametrize(("module", "target", "least"), [(toxicity, "toxic", 0.9), (quality, "quality", 0.97)])
def test_classifiers_on_held_out_rows(spark, edge, module, target, least):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = docs.join(labels, "doc_id", "left_semi")
    got = module.report(known, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 500 and ((held.predicted == held[target]).mean() > least)
    if target == "toxic":
        assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.02
    out = module.report(docs.limit(300).select("doc_id", "text").unionByName(edge.select("doc_id", "text")), labels).toPandas()
    assert len(out) == 300 + edge.count() and out.score.between(0, 1).all()
    assert module.report(edge, labels.limit(0)).agg(F.max("score")).first()[0] == 0.0


def naive_evidence(docs):
    """The same models by definition, as dicts: evidence(previous word or None, word)."""
    pairs = [Counter(), Counter()]
    for label, w in docs:
        pairs[label].update(set(zip([None, *w], w)))
    spelt = [Counter(), Counter()]
    top, ahead = [Counter(), Counter()], [defaultdict(set) for _ in range(toxicity.ORDER)]

    def grams(word):
        x = b" " + word + b"\n"
        return [x[max(0, k - toxicity.ORDER + 1) : k + 1] for k in range(1, len(x))]

    for word in {w for _, w in pairs[0] | pairs[1]}:
        n = [sum(c for (_, v), c in pairs[k].items() if v == word) for k in (0, 1)]
        for g in grams(word):
            for k in (0, 1):
                top[k][g] += n[k]
            for size in range(1, min(len(g) - 1, toxicity.BACK) + 1):
                ahead[size][g[-size:]].add(g[-size - 1])

    def model(counts, split):
        counts = {g: n for g, n in counts.items() if n}
        d = toxicity.discounts(np.array(list(counts.values()), int))
        total, free = Counter(), Counter()
        for g, n in counts.items():
            total[split(g)] += n
            free[split(g)] += d[min(n, 3)]
        return lambda g, back: ((counts.get(g, 0) - d[min(counts.get(g, 0), 3)]) + free[split(g)] * back) / total[split(g)] if total[split(g)] else back

    lower = [model({g: len(x) for g, x in a.items()}, lambda g: g[:-1]) for a in ahead]
    classes = [model(c, lambda g: g[:-1]) for c in top]

    def spelling(word, k):
        total = 0.0
        for g in grams(word):
            p = 1 / 256
            for size in range(1, min(len(g) - 1, toxicity.BACK) + 1):
                p = lower[size](g[-size:], p)
            total += math.log(classes[k](g, p))
        return total

    pooled, own = model(pairs[0] + pairs[1], lambda g: g[0]), [model(c, lambda g: g[0]) for c in pairs]

    def evidence(before, word):
        back = [math.exp(spelling(word, k)) for k in (0, 1)]
        p = [own[k]((before, word), pooled((before, word), back[k])) for k in (0, 1)]
        return math.log(p[1] / p[0])

    return evidence, lambda w: spelling(w, 1) - spelling(w, 0)


def test_toxicity_models_equal_their_definition(spark):
    from touchline.llm.common import words

    listed = [(k % 3 == 0, words((t or "")[:400].encode())) for k, (_, t) in enumerate(texts(read(spark, "documents").limit(24)))]
    listed[0][1].extend([b"stupid", b"clown", b"of", b"a", b"stupid", b"clown"])
    sample = spark.createDataFrame([(int(k), bytearray(b" ".join(w))) for k, w in listed], "label int, text binary")
    model = toxicity.learnt(sample).open()
    evidence, spelling = naive_evidence([(int(k), w) for k, w in listed])
    asked = [w for _, one in listed[:6] for w in one][:60] + [b"clowns", b"stupidest", b"never-seen", "ä".encode(), b"x" * 40]
    _, told = model.spelling(asked)
    assert told == pytest.approx([spelling(w) for w in asked], abs=1e-4)
    for text in (b"a stupid clown of nothing", b"", b"the stupid", b" ".join(listed[1][1][:30])):
        w = words(text)
        e = [evidence(p, x) for p, x in zip([None, *w], w)]
        weigh = lambda x: math.log1p(toxicity.SHARE * math.expm1(min(x, toxicity.MOST_EVIDENCE)))
        plain = sum(weigh(spelling(x)) for x in set(w))
        paired = sum(weigh(max(v for v, y in zip(e, w) if y == x)) for x in set(w))
        kinds = max(len(set(w)), 1)
        want = [sum(e) / max(len(w), 1), 20 * plain / kinds, plain / kinds**0.5, paired / kinds**0.5]
        assert model.features([text])[0] == pytest.approx(want, abs=1e-3)


def test_discriminant_equals_gaussian_densities():
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (80, 4)) @ rng.normal(0, 1, (4, 4)), rng.normal(1, 2, (50, 4)) @ rng.normal(0, 1, (4, 4))])
    y = np.repeat([0, 1], [80, 50])
    model = quality.Discriminant(x, y)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    cov = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(c * (y == k).mean() for k, c in enumerate(cov))
    pooled = (1 - quality.SHRINK_DIAGONAL) * pooled + quality.SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + 1e-3 * np.eye(4)
    told = []
    for k in (0, 1):
        s = (1 - quality.SHRINK_CLASS) * cov[k] + quality.SHRINK_CLASS * pooled
        d = z - z[y == k].mean(0)
        told.append(-0.5 * np.einsum("ij,ij->i", d @ np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert model.log_ratio(x) == pytest.approx(told[1] - told[0], rel=1e-9)


def test_labelled_sample_keeps_its_bounds(spark):
    from touchline.llm.learning import labelled_sample

    docs = spark.createDataFrame([(k % 8, "x" * (k + 1)) for k in range(64)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)] * 3, "doc_id long, toxic int")
    one = labelled_sample(docs, labels, "toxic", 5, 9, 2).collect()
    assert sorted(r.label for r in one) == [0, 0, 1, 1] and all(len(r.text) == r.doc_id + 1 for r in one)
    few = labelled_sample(docs, labels, "toxic", 5, 9, 4, most_bytes=96).collect()
    assert few and all(sum(len(r.text) for r in few if r.label == k) <= 96 and max(len(r.text) for r in few) <= 6 for k in (0, 1))


# 8


def test_decontamination_equals_brute_force(spark, edge):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(low(t))
    items = read(spark, "benchmark").unionByName(spark.createDataFrame([(900, "one two"), (901, None), (902, ""), (903, "gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (904, "ONE-two")], "item_id long, text string"))
    windows = defaultdict(set)
    for r in items.collect():
        w = words(r.text)
        for k in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[k : k + 10])].add(str(r.item_id))
    docs = read(spark, "documents").select("doc_id", "text").unionByName(edge.select("doc_id", "text").filter("length(text) < 1000 OR text IS NULL")).dropDuplicates()
    for most in (500_000, 200):
        got = decontaminate.decontaminate(docs, items, most=most).collect()
        for r in got:
            w, hit, found = words(r.text), set(), set()
            for n in {len(x) for x in windows}:
                for k in range(len(w) - n + 1):
                    if (x := tuple(w[k : k + n])) in windows:
                        hit |= set(range(k, k + n))
                        found |= windows[x]
            told = {p for a, b in zip(r._hits[::2], r._hits[1::2]) for p in range(a, b)}
            assert (r._n_words, told, set(r._items)) == (len(w), hit, found)
    out = decontaminate.clean(edge, items)
    assert out.columns == edge.columns and out.filter("text = 'one two'").count() == 0 and out.filter("doc_id = 3").count() == 1
    assert decontaminate.report(edge, items.limit(0)).filter("contaminated").count() == 0


# 10


def brute(rows):
    sets = {}
    for i, t in rows:
        w = low(t).encode().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(n, seed):
    """Texts around the threshold: each a base of n words with some replaced."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10 * n, n)]
    for _ in range(12):
        w = list(base)
        for p in rng.integers(0, n, rng.integers(0, max(2, n // 25))):
            w[p] = f"e{rng.integers(0, 1 << 30)}"
        yield " ".join(w)


@pytest.mark.parametrize("items", [3_000_000, 500])
def test_join_equals_brute_force(spark, edge, items, monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE", 3)
    made = [t for n in (5, 7, 12, 30, 48, 60, 150, 400) for s in (1, 2) for t in edited(n, n + s)]
    docs = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(made)], "doc_id long, text string").unionByName(edge.select("doc_id", "text").filter("doc_id IS NOT NULL"))
    monkeypatch.setattr(jaccard.verified_links, "__defaults__", (items,))
    got = jaccard.report(docs).collect()
    want = brute(texts(docs))
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert jaccard.report(docs.limit(0)).count() == 0


def test_signatures_meet_at_the_threshold():
    rng = np.random.default_rng(5)
    for n in (1, 4, 5, 9, 41, 50, 51, 64, 120, 700):
        for _ in range(20):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            drop, add = rng.integers(0, n // 9 + 1), rng.integers(0, n // 9 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                assert set(jaccard.signatures(a)) & set(jaccard.signatures(b))


def test_one_document_of_each_group_stays(spark, edge):
    kept = jaccard.representatives(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 8, 9, 10, None]))


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000, 1000 + k) for k in range(1, 200)]
    top = {x: x for p in pairs for x in p}
    find = lambda x: x if top[x] == x else find(top[x])
    for a, b in pairs:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in top)


# The pipeline


def test_pipeline_stages_keep_columns_and_decide(spark, tmp_path):
    docs, rows = read(spark, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows.append((name, before, docs.count()))
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near copies":
            found = brute(texts(docs))
            assert all(found[i][1] == i for i in found)
        if name == "decontamination":
            assert decontaminate.report(docs, read(spark, "benchmark")).filter("contaminated").count() == 0
    assert [n for n, _, _ in rows] == ["toxicity", "near copies", "decontamination", "mixing", "sharding"]
    assert all(b <= a for n, a, b in rows if n != "mixing") and rows[-1][2] == rows[-1][1]


def untouched(out, docs, key="doc_id"):
    """Whether rows of out are rows of docs, with all their columns."""
    assert out.columns == docs.columns
    rows = lambda df: Counter(map(str, df.select(*(F.md5(F.col(f"`{c}`").cast("binary")).alias(f"c{k}") if t == "string" else F.col(f"`{c}`").alias(f"c{k}") for k, (c, t) in enumerate(df.dtypes))).collect()))
    assert set(rows(out)) <= set(rows(docs))


def test_every_report_bears_odd_rows(spark, odd, edge):
    labels, benchmark = read(spark, "labels"), read(spark, "benchmark")
    labels = labels.select("*", F.lit(1).alias("_order"), F.lit("x").alias("text"))
    reports = [
        ppm.report, lambda d: ppm.report(d, 5, 500), sharding.report, secrets.find_secrets, mixing.report, lambda d: toxicity.report(d, labels), lambda d: quality.report(d, labels),
        lambda d: decontaminate.report(d, benchmark), jaccard.report,
    ]
    for k, f in enumerate(reports):
        got = f(odd)
        assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r.doc_id) for r in odd.collect()), k
        assert f(odd.limit(0)).count() == 0
    told = {r.doc_id: r for r in jaccard.report(odd).collect()}
    assert told[20].component_id == 20 and told[20].n_shingles == 1
    assert {r.doc_id: r.n_tokens for r in ppm.report(odd).collect()}[20] == 3
    pages = odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"), "_score", "n", F.lit("x").alias("digest"), F.lit("x").alias("payload"))
    assert warc.round_trip(pages).count() == odd.count()


def test_every_stage_bears_odd_rows(spark, odd, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        if name != "sharding":
            untouched(out, odd)
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_a_benchmark_beyond_one_index_bears_odd_rows(spark, odd):
    benchmark = read(spark, "benchmark").select(F.col("item_id"), F.concat_ws(" ", "text", F.lit("tail")).alias("text"))
    benchmark = benchmark.unionByName(spark.createDataFrame([(None, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet"), (77, None)], "item_id long, text string").select(F.col("item_id").cast(benchmark.schema["item_id"].dataType).alias("item_id"), "text"))
    untouched(decontaminate.clean(odd, benchmark, most=50), odd)
    rows = decontaminate.clean(odd, benchmark, most=50).select("doc_id").collect()
    assert 21 not in {r.doc_id for r in rows} and len(rows) == odd.count() - 1
    assert decontaminate.clean(odd.limit(0), benchmark, most=50).count() == 0


@pytest.mark.parametrize("weight", [None, "n"])
def test_lookups_beyond_a_broadcast_equal_plain_joins(spark, monkeypatch, weight):
    from touchline.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 20)
    left = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 100) END AS key", "id AS _salt", "concat('a', id) AS `_hash`")
    right = left.filter("key IS NOT NULL AND _salt % 7 <> 0").groupBy("key").agg(F.count("*").alias("n"), F.max("_salt").alias("v"))
    want = Counter(map(tuple, left.join(right.drop("n"), "key", "left").select("key", "_salt", "_hash", "v").collect()))
    got = common.lookup(left, right if weight else right.drop("n"), "key", weight, salts=4, hot=100)
    assert Counter(map(tuple, got.select("key", "_salt", "_hash", "v").collect())) == want


def test_work_folders_are_released(spark):
    from touchline.llm.common import release, settle

    kept = settle(spark.range(5), "t")
    assert kept.count() == 5
    release(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(kept.settled_at).count()


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in queries.queries()} == {f"op{n}" for n in range(1, 11)}
    assert set(queries.oracle_sql()) <= set(queries.queries())
