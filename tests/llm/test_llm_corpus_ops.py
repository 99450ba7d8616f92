"""Near duplicates, leaks, mixing, sharding, archives, classifier, pipeline: brute force and odd rows."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtide.llm import classifier, common, decontamination, mixing, near_dedup, sharding, warc
from test_llm_text_ops import odd

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, both in collections.Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return {rows[i][0]: min(groups[find(i)]) for i in range(len(rows))}, {rows[i][0]: len(sets[i]) for i in range(len(rows))}


def families(seed=0):
    """Bases with copies of growing distance, one large family, and short texts."""
    draw = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, at = [], 0
    for size, length in [(1, 200)] * 20 + [(6, 120)] * 12 + [(150, 150)] + [(4, 6), (5, 3), (3, 1)]:
        base = draw.choice(vocabulary, length).tolist()
        for c in range(size):
            copy = list(base)
            for p in draw.choice(length, min(length, c % 7), replace=False):
                copy[p] = f"new{draw.integers(10**6)}"
            rows.append((at, " ".join(copy)))
            at += 1
    rows += [(at, rows[3][1].upper().replace("V", "v")), (at + 1, rows[25][1] + " tail"), (at + 2, ""), (at + 3, None), (at + 4, " \n")]
    draw.shuffle(rows)
    return [(int(a), b) for a, b in rows]


@pytest.mark.parametrize("percent,block", [(85, 512), (80, 16)])
def test_components_against_brute_force(spark, monkeypatch, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", block)
    rows = families()
    want, size = brute_components(rows, percent)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], size[r.doc_id], want[r.doc_id] == r.doc_id)


def test_registers_are_mergeable_and_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:3000])
    ka, kb, both = near_dedup.sketches([a, b, np.union1d(a, b)], 600)
    assert (np.maximum(ka, kb) == both).all()
    assert abs((ka == kb).mean() - 1500 / 3000) < 0.08
    at = lambda t: near_dedup.possible(*[np.array([x], float) for x in ((ka == kb).sum(), (ka > kb).sum(), (ka < kb).sum(), len(a), len(b))], t)[0]
    assert at(0.5) and not at(0.75)


def test_likelihood_rejects_no_pair_over_the_threshold():
    draw = np.random.default_rng(2)
    m = near_dedup.bands_for(85) * near_dedup.ROWS
    for _ in range(150):
        pool = draw.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = np.unique(pool[:370]), np.unique(pool[30:])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        ka, kb = near_dedup.sketches([a, b], m)
        keys = near_dedup.band_keys(np.stack([ka, kb]), near_dedup.ROWS)
        assert j < 0.85 or ((keys[0] == keys[1]).any() and near_dedup.possible(
            *[np.array([x], float) for x in ((ka == kb).sum(), (ka > kb).sum(), (ka < kb).sum(), len(a), len(b))], 0.85)[0])


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


BENCH = [(1, "In March Anna Smith bought 12 apples for 5 dollars and then sold 12 pears to Bob for 30 cents each."),
         (2, "Short item text."), (3, None), (4, "the quick brown fox jumps over the lazy dog while seven bright birds watch from trees")]


def test_leaks_with_other_slots(spark):
    docs = [
        (1, "Noise before. " + BENCH[0][1] + " Noise after."),
        (2, "Well well. In March Carl Jones bought 7 apples for 9 dollars and then sold 7 pears to Eve for 41 cents each. So."),
        (3, "Well well. In March Carl Jones bought 7 apples for 9 dollars and then sold 8 pears to Eve for 41 cents each. So."),
        (4, "Nothing of the kind is said in this text about apples and pears and their prices in the shop."),
        (5, None), (6, ""), (7, "x THE QUICK brown fox jumps over the lazy dog while seven bright birds, watch from trees y"),
        (1, "Noise before. " + BENCH[0][1] + " Noise after."), (8, "only the quick brown fox jumps over the lazy dog here and nothing else at all"),
        (None, BENCH[3][1]), (9, "word " * 100_000),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.changed for r in decontamination.leaks(docs, bench).collect()}
    assert got == {(1, 1): False, (2, 1): True, (7, 4): False, (None, 4): False}
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} == {3, 4, 5, 6, 8, 9}
    assert decontamination.leaks(docs.where("false"), bench).count() == 0
    assert decontamination.leaks(docs, bench.where("false")).count() == 0


def test_verbatim_copies_of_dense_and_short_items_leak(spark):
    items = [(1, "Compute 12 + 34 + 5 + 7 + 8"), (2, "What is 12 plus 34 minus 5 times 7?"), (3, "Boil 3 eggs"), (4, "12 m in 5 s at 3 km h")]
    docs = [(i, f"some words before\n{t}\nand some words after") for i, t in items]
    docs += [(11, "Compute 12 + 34 + 6 + 9 + 1"), (12, "What is 1 plus 4 minus 9 times 2?"), (13, "Boil 4 eggs"), (14, "13 m in 6 s at 4 km h")]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.changed) for r in found.collect()} == {(i, i, False) for i, _ in items}


def brute_leaks(rows, items):
    index = collections.defaultdict(set)
    for item, text in items:
        w = [x.lower() for x in WORD.findall(text)]
        for i in range(len(w) - 7):
            index[tuple(w[i:i + 8])].add(item)
    out = set()
    for doc, text in rows:
        w = [x.lower() for x in WORD.findall(text or "")]
        hits = collections.Counter(item for i in range(len(w) - 7) for item in index.get(tuple(w[i:i + 8]), ()))
        out |= {(doc, item) for item, n in hits.items() if n >= 4}
    return out


def test_leaks_of_the_test_tables(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute_leaks(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == want


def brute_targets(sizes):
    """Share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        over = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over


def test_mix(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = [(i, " ".join(["w"] * int(draw.integers(0, 120))), ["big", "b", "é", "z", None, "tiny"][0 if i % 3 == 0 else i % 6]) for i in range(3000)]
    rows += [(5000, None, "empty"), (5001, "", "empty"), (7, "w w w", "b"), (None, "w " * 50, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    got = mixing.mix(df).toPandas()
    assert len(got) == len(rows) and sorted(got["size"]) == sorted(len(WORD.findall(t or "")) for _, t, _ in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(dict(sizes))
    got["source"] = got["source"].where(got["source"].notna(), None)
    for source, part in got.groupby(got["source"].fillna("none"), dropna=False):
        name = None if source == "none" else source
        assert part["target"].iloc[0] == pytest.approx(want[name])
        assert abs(part["taken"].sum() - want[name]) <= 240
    assert (got["taken"] <= 3 * got["size"]).all() and (got["taken"] == got["copies"] * got["size"]).all()
    again = mixing.mix(df.repartition(5)).toPandas()
    order = ["doc_id", "size", "taken"]
    assert got[order].sort_values(order).values.astype(float).tolist() == again[order].sort_values(order).values.astype(float).tolist() or (
        got[order].fillna(-1).sort_values(order).values.tolist() == again[order].fillna(-1).sort_values(order).values.tolist())


def test_fractions_keep_their_expectation(spark):
    import pandas as pd
    total = np.zeros(9)
    for seed in range(600):
        draw = np.random.default_rng(seed)
        rows = pd.DataFrame({"key": range(9), "size": range(9), "p": np.linspace(0.1, 0.9, 9), "u": draw.random(9)})
        out = mixing._fights(rows).sort_values("key")
        assert out["extra"].isna().sum() <= 1
        total += out["extra"].fillna(0).to_numpy(float) + out["p"].to_numpy()
    assert np.abs(total / 600 - np.linspace(0.1, 0.9, 9)).max() < 0.08


def test_mix_odd_rows(spark):
    assert mixing.mix(odd(spark)).count() == 8 and mixing.mix(odd(spark).where("false")).count() == 0


def test_shards(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = sharding.shard(docs, 4, 64).toPandas()
    assert sorted(out["doc_id"]) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    load = out.groupby("shard")["size"].sum()
    assert load.max() - load.min() <= out.groupby("virtual_slot")["size"].sum().max()
    assert (out.groupby("virtual_slot")["shard"].nunique() == 1).all()
    odd_rows = sharding.shard(odd(spark))
    assert odd_rows.count() == 8 and sharding.shard(odd(spark).where("false")).count() == 0
    assert odd_rows.columns.count("size") == 1 and odd_rows.columns.count("shard") == 1


def test_map_edits_move_only_what_balances(spark, tmp_path):
    draw = np.random.default_rng(0)
    loads = {s: int(draw.integers(1, 1000)) for s in range(256)}
    first = sharding.SlotMap.first(256, 8)
    plan = first.edited(loads)
    assert len(plan.versions) == 2 and plan.versions[0] == first.current
    total = collections.Counter()
    for slot, shard in enumerate(plan.current):
        total[shard] += loads[slot]
    assert max(total.values()) - min(total.values()) < 20
    assert sum(a != b for a, b in zip(*plan.versions)) < 128
    grown = plan.edited(loads, 9)
    assert all(b == a or b == 8 or a != b for a, b in zip(plan.current, grown.current)) and 8 in grown.current
    plan.save(spark, str(tmp_path / "map"))
    assert {(r.slot, r.shard) for r in sharding.SlotMap.load(spark, str(tmp_path / "map")).collect()} == set(enumerate(plan.current))


def pages(spark):
    big = "<p>" + "é" * 900 + "</p>"
    rows = [(i, f"http://x/{i}", f"<html>{i}" + "text " * (i * 37 % 400)) for i in range(60)]
    rows += [(100, "u v\r\n", big), (101, None, big), (102, "u", big), (103, "u", "small"), (104, "u", "small"), (105, "u", None), (106, "u", "")]
    rows += [(107, "u", "random " + "".join(map(chr, np.random.default_rng(1).integers(32, 5000, 30_000)))), (None, "u", "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


@pytest.mark.parametrize("split", [500, 7_001, 8 * 2**20])
def test_archives_in_any_split(spark, tmp_path, split):
    df = pages(spark)
    files = warc.write_warc(df, str(tmp_path))
    got = warc.read_warc(files, split)
    bodies = {r.record_id: bytes(r.payload).decode() for r in got.where("record_type = 'response'").collect()}
    want = {f"<urn:page:{'none' if r.page_id is None else r.page_id}>": r.html or "" for r in df.collect()}
    assert len(bodies) == len(want) - 2 and all(want[k] == v for k, v in bodies.items())
    ids = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.page_records(got).collect()}
    assert len(ids) == len(want) and ids[100][:2] == ids[101][:2] == ("revisit", 102) and ids[102][:2] == ("response", None)
    assert ids[100][2:] == ids[102][2:] and ids[103][0] == ids[104][0] == "response" and ids[105][2] == 0
    assert warc.read_warc(warc.list_warc(spark, f"file:{tmp_path}"), split).count() == len(want)


def test_damaged_members_are_passed_over(spark, tmp_path):
    files = warc.write_warc(pages(spark).coalesce(1), str(tmp_path)).collect()
    path = files[0].path
    data = bytearray(open(path, "rb").read())
    offsets = sorted(r.offset for r in warc.read_warc(spark.createDataFrame(files)).collect())
    data[offsets[5] + 40:offsets[5] + 60] = bytes(20)
    data += b"\x1f\x8b\x08" + b"junk" * 9 + zlib.compress(b"x")
    open(path, "wb").write(data)
    listed = spark.createDataFrame([(path, len(data))], "path string, bytes long")
    assert sorted(r.offset for r in warc.read_warc(listed, 3000).collect()) == offsets[:5] + offsets[6:]


def test_no_pages(spark, tmp_path):
    files = warc.write_warc(pages(spark).where("false"), str(tmp_path))
    assert warc.read_warc(files).count() == 0


def small_net(seed=0):
    draw = np.random.default_rng(seed)
    f = classifier.FILTERS
    return classifier.ByteCNN(draw.normal(0, 1, (classifier.WIDTH, 257, f)).astype(np.float32), draw.normal(0, 1, f), draw.normal(0, 1, (3 * f, 4)),
                              draw.normal(0, 1, 4), draw.normal(0, 1, 4), 0.1)


@pytest.mark.parametrize("size", [0, 1, 5, 250, 256, 257, 1000, 40_000])
def test_pooling_covers_the_whole_text(monkeypatch, size):
    draw = np.random.default_rng(size)
    text = bytes(draw.integers(32, 127, size, dtype=np.uint8)).decode()
    net = small_net()
    monkeypatch.setattr(classifier, "BLOCK", 1024)
    symbols = [classifier.PAD] * classifier.WIDTH + list(text.encode()) + [classifier.PAD] * classifier.WIDTH
    response = np.array([sum(net.table[j][symbols[t + j]] for j in range(classifier.WIDTH)) for t in range(size + classifier.WIDTH)])
    n, half = len(response), classifier.HALF
    starts = range(0, max(1, -(-n // half) - 1))
    want = np.stack([np.maximum(response[s * half:(s + 2) * half].max(0) + net.bias, 0) for s in starts])
    assert np.allclose(net.pooled(text), want, atol=1e-4)
    assert 0 <= net.score(text) <= 1


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    out = classifier.classify(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where(classifier.held_out()).toPandas()
    right = out["predicted"] == out["quality"]
    assert right.mean() > 0.9 and right[out["quality"] == 1].mean() > 0.9
    assert classifier.held_out and set(out["predicted"]) == {0, 1}


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (4, 1), (6, 1), (None, 0), (2, None)], "doc_id long, quality int")
    out = classifier.classify(odd(spark), labels).toPandas()
    assert len(out) == 8 and out["score"].between(0, 1).all() and set(out["predicted"]) <= {0, 1}
    assert classifier.classify(odd(spark).where("false"), labels).count() == 0
    assert (classifier.classify(odd(spark), labels.where("false")).toPandas()["score"] == 0.5).all()


def test_near_duplicates_odd_rows(spark):
    out = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd(spark)).collect()}
    assert {(1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 1, None, True), (5, 0, 5, True)} <= out and len(out) == 7
    assert near_dedup.near_duplicates(odd(spark).where("false")).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, FOLDER)
    assert kept.columns == columns and 0 < kept.count() <= docs.count()

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = brute_components(rows, 80)
    deduped = stages["near_duplicates"](spark, docs, FOLDER)
    assert deduped.columns == columns
    assert {r.doc_id for r in deduped.collect()} == {d for d, c in want.items() if d == c}

    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()
    leaked = {d for d, _ in brute_leaks(rows, items)}
    clean = stages["benchmark"](spark, docs, FOLDER)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - leaked

    mix = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    mixed = stages["mixing"](spark, docs, FOLDER)
    assert mixed.columns == columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({d: c for d, c in mix.items() if c})

    placed = stages["sharding"](spark, docs, FOLDER).toPandas()
    assert len(placed) == len(rows) and all(sorted(p["slot"]) == list(range(len(p))) for _, p in placed.groupby("shard"))


def test_stages_decide_per_row_where_ids_repeat_or_are_null(spark):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    rows = [(None, text(i), "a") for i in range(100)] + [(7, text(100 + i), "a") for i in range(50)]
    rows += [(None, text(1000 + i), "b") for i in range(20)] + [(7, text(2000), "b")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source] += r.copies
    got = collections.Counter((r.doc_id, r.source) for r in corpus_pipeline.mixed(spark, docs, FOLDER).collect())
    assert got == +want

    rows = [(1, text(1), "a")] * 3 + [(1, text(1) + " x", "a"), (2, text(1), "b"), (None, text(2), "a"), (None, text(2), "b"), (None, text(3), "a"),
                                      (None, text(2) + " y", "a"), (4, "", "a"), (4, "", "a"), (None, None, "a"), (3, text(4), "a"), (None, text(4), "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    left = collections.Counter((r.doc_id, (r.text or "")[:4]) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect())
    assert left == {(1, "w1x0"): 1, (None, "w2x0"): 1, (None, "w3x0"): 1, (4, ""): 2, (None, ""): 1, (3, "w4x0"): 1}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    """All columns of the odd rows, and more that stages use themselves, come through with their values."""
    more = {"copies": F.lit(7), "_row": F.lit("r"), "slot": F.lit(-1), "predicted": F.lit("p"), "component_id": F.lit(5), "_copy": F.lit(1.5)}
    docs = odd(spark).withColumns(more)
    out = stage(spark, docs, FOLDER)
    added = ["shard", "slot"] if name == "sharding" else []
    old = [f"{c}_before" if c in added else c for c in docs.columns]
    assert out.columns == old + added
    listed = lambda df: [repr(tuple(r)) for r in df.collect()]
    before, after = collections.Counter(listed(docs)), collections.Counter(listed(out.select(*old)))
    assert set(after) <= set(before)
    if name in ("benchmark", "sharding"):
        assert after == before
    elif name == "near_duplicates":
        assert max(after.values()) == 1 and len(after) == len(before)
    elif name == "mixing":
        assert all(n <= 3 * before[row] for row, n in after.items())
    assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_warc_headers_of_other_writers():
    """No space after the colon, other case, folded lines, other record types; broken ones are passed over."""
    record = lambda *lines, block=b"": ("\r\n".join(["WARC/1.0", *lines, f"Content-Length:{len(block)}"]) + "\r\n\r\n").encode("latin-1") + block
    info = warc._parse(record("WARC-Record-ID:<urn:a>", "warc-type:\twarcinfo", "WARC-Target-URI: http://x/\u00e9", block=b"software: y\r\n\r\nmore"))
    assert (info["record_id"], info["record_type"], info["payload"], info["declared_bytes"]) == ("<urn:a>", "warcinfo", b"software: y\r\n\r\nmore", 19)
    page = warc._parse(record("WARC-Record-ID: <urn:b>", "WARC-Type: response", "WARC-Payload-Digest: sha1:???", block=b"HTTP/1.1 200 OK\r\ncontent-length:4\r\n\r\nbody"))
    assert (page["payload"], page["declared_bytes"], page["declared_digest"]) == (b"body", 4, None)
    assert warc._parse(record("WARC-Type: response")) is None
    assert warc._parse(b"WARC/1.0\r\nWARC-Record-ID: <a>\r\nWARC-Type: response\r\n\r\nx") is None
