"""Small brute-force tests of the training-data operators: nulls, empties, ties, repeated rows, extra columns, empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import chat, decontaminate, embeddings, minhash, packing, sharding, substring, toxicity, urls, warc
from strandloom.functions.scratch import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid string, score double, bucket int"


def words(t):
    return WORD.findall(t or "")


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    base, passage = say(120), say(60)
    texts = [say(rnd.randint(5, 200)) for _ in range(30)]
    for i in range(20):  # near copies of one text, at many distances
        w = base.split()
        for _ in range(i // 2):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts.append(" ".join(w))
    texts += [f"{say(20)} {passage} {say(30)}", f"{passage}\n{say(10)}", f"{say(9)}\t{passage}", base, base, "", None, None, "one", "one two", "ONE Two", "a b c d e", "\x1c\x85 odd\x0bspace ", say(40) * 30]
    rows = [(i, t, "en", "src", len(t or ""), "x", 0.5, 1) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[4], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_minhash(docs, none):
    rows = corpus()
    low = lambda t: words((t or "").translate({c: c + 32 for c in range(65, 91)}))
    sets = []
    for r in rows:
        w = low(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    want = Counter((r[0], len(sets[i]), min(least[find(i)]) if sets[i] and least[find(i)] else r[0]) for i, r in enumerate(rows))
    got = minhash.near_duplicates(docs, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(none, 85).count() == 0


def _thue_morse(n):
    t = "ab"
    while len(t) < n:
        t += t.translate({97: 98, 98: 97})
    return t


def test_words_of_repetitive_spelling_differ(spark):
    a = _thue_morse(2048)
    b = a.translate({97: 98, 98: 97})
    d = spark.createDataFrame([(1, a), (2, b), (3, a), (4, f"{a} {b} {a} {b} {a} {b}"), (5, f"{b} {a} {b} {a} {b} {a}")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(d, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4} or got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_minhash_stage(spark, docs, none):
    out = minhash.stage(spark, docs, "")
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.select("doc_id").collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids))
    assert minhash.stage(spark, none, "").count() == 0


def _cover(rows, width=35):
    seen = Counter()
    for r in rows:
        w = words(r[1])
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((r[0], len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("batches", [1, 5])
def test_substring(docs, batches):
    got = substring.remove_repeats(docs, ["doc_id"], batches=batches).collect()
    assert Counter((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == _cover(corpus())


def test_substring_empty(none):
    assert substring.remove_repeats(none, ["doc_id"]).count() == 0


def test_substring_against_history(spark):
    """Batch after batch with an index gives what one look at all documents gives for the last batch."""
    rows = [r for r in corpus() if r[0] is not None]
    deal = lambda k: [r for r in rows if r[0] % 3 == k]
    index = substring.FingerprintIndex(spark, new_path(spark, "test-index"))
    seen = spark.createDataFrame([], DOCS)
    for k in range(3):
        batch = spark.createDataFrame(deal(k), DOCS)
        got = substring.remove_repeats(batch, ["doc_id"], batches=1, index=index, history=seen).collect()
        seen = seen.union(batch)
        every = [r for j in range(k + 1) for r in deal(j)]
        want = _cover(every)
        own = {r[0] for r in deal(k)}
        assert Counter((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter({w: n for w, n in want.items() if w[0] in own})
    # an exact copy of an old document goes whole, through an index opened anew
    index.save()
    again = substring.FingerprintIndex.open(spark, index.path)
    copy = spark.createDataFrame([(7000, rows[0][1] + " " + rows[1][1])], "doc_id long, text string")
    got = substring.remove_repeats(copy, ["doc_id"], batches=1, index=again, history=seen).collect()
    n = sum(len(words(rows[i][1])) for i in (0, 1) if len(words(rows[i][1])) >= 35)
    assert n and [r.n_removed for r in got] == [n]
    with pytest.raises(ValueError):
        substring.remove_repeats(copy, ["doc_id"], index=again)


def test_fingerprint_index_compacts_and_opens(spark, docs):
    index = substring.FingerprintIndex(spark, new_path(spark, "test-index"))
    marks = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text").mapInArrow(substring._fingerprints(35, 5), "batch int, fp long, n long").cache()
    hits = set()
    for k in range(5):
        hits |= {r.fp for r in index.add(marks.where(F.col("batch") == k).select("fp", "n")).collect()}
    assert sorted(level for level, _ in index.runs) == [0, 1]
    index.save()
    again = substring.FingerprintIndex.open(spark, index.path)
    assert again.runs == index.runs and again.buckets == index.buckets
    assert {r.fp for r in again.hashes().where("n > 1").collect()} == hits
    want = Counter()
    for r in marks.collect():
        want[r.fp] += r.n
    assert {r.fp: r.n for r in again.hashes().collect()} == dict(want)
    own = again._read(again.runs[0][1]).join(again._read(again.runs[1][1]), "fp", "left_semi")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # runs meet bucket by bucket


def test_toxicity(spark, none):
    rnd = random.Random(3)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    rows = [(i, say(30) + (" dreadful" if i % 4 == 0 else "")) for i in range(400)] + [(400, ""), (401, None), (3, say(5))]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("own"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(5, None), (7, 0)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled(d, labels))
    got = toxicity.score(d, model, ["doc_id", "label"]).select("row.*", "score").collect()
    assert len(got) == len(rows)
    held = [r for r in got if 300 <= r.doc_id < 400]
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held)
    assert all(0 <= r.score < 0.5 for r in got if r.doc_id in (400, 401))
    empty = toxicity.fit(toxicity.labelled(none, labels))
    assert toxicity.score(none, empty, ["doc_id"]).count() == 0
    assert all(r.score == 0.5 for r in toxicity.score(d, empty, ["doc_id"]).collect())


def test_urls(spark):
    given = ["http://A.Com/en/x", "https://www.example.com/en/7?q", "x://net/de/1", "x://a.example.net/de/8#e", "x://org/es/", "nothing", None, "http://", "x://a.com", "x://?q=://b", "x://com/EN/", "y\n://b.org/es/1"]
    d = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(d).collect()}
    assert [got[i].rule for i in range(5)] == ["com/en/", "example.com/en/7", "net/de/", "example.net/de/8", "org/es/"]
    assert [got[i].verdict for i in range(5)] == ["block", "allow", "allow", "block", "block"]
    assert [(got[i].host, got[i].path) for i in (0, 5, 6, 7, 8, 9)] == [("a.com", "/en/x"), ("", ""), ("", ""), ("", ""), ("a.com", ""), ("", "")]
    assert got[10].rule is None and got[5].verdict == "allow" and got[11].rule == "org/es/"
    assert urls.judge(d.limit(0)).count() == 0


def test_url_model_sums_to_one():
    counts = np.random.default_rng(0).integers(0, 3, urls._A ** (urls.ORDER + 1))
    p = np.exp(urls._log_model(counts)).reshape(-1, urls._A)
    assert np.allclose(p.sum(axis=1), 1)


def test_sharding(spark, docs, none):
    eight = {s: 1.0 for s in range(8)}
    rows = corpus()
    got = sharding.shards(docs, eight, eight | {8: 1.0}).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert sharding.shards(none, eight, eight).count() == 0
    many = spark.range(4000)
    share = sharding.assign(many, "id", {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()
    assert abs({r.shard: r["count"] for r in share}[1] / 4000 - 0.75) < 0.05


def test_packing(spark, docs, none):
    got = packing.pack_documents(docs).collect()
    assert packing.pack_documents(none).count() == 0
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = Counter()
    for r in corpus():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or min(2048, len(ids))
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            want[(r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 2048) + 1


def test_packing_crossover_keeps_every_piece():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 2048, 300)
    a, b = (packing._seeded(lengths, rng, 2048, x) for x in (0.0, 2.0))
    for child in (packing._cross(lengths, a, b, rng, 2048), packing._mutate(lengths, a, rng, 2048)):
        assert (child >= 0).all() and np.bincount(child, lengths).max() <= 2048


def test_packing_crossovers_improve_on_best_fit():
    """Triplets that fill a bin exactly: best fit, longest first, wastes bins that the evolution gains back."""
    gained = 0
    for seed in range(6):
        rng = np.random.default_rng(seed)
        a = rng.integers(380, 490, 40)
        b = np.array([rng.integers(250, (1000 - x) // 2) for x in a])
        lengths = np.concatenate([a, b, 1000 - a - b])
        people = [packing._seeded(lengths, rng, 1000, x) for x in packing.NOISE]
        rated, used = packing._evolve(lengths, people, rng, 1000, 400)
        assert used and -rated[0][0][0] <= min(p.max() + 1 for p in people)
        gained += int(people[0].max()) + 1 + rated[0][0][0]
    assert gained >= 3


def test_packing_reports_the_evolution(spark, docs):
    report = []
    got = packing.pack_documents(docs, capacity=64, report=report)
    assert report and all(r["crossovers"] and r["bins_after"] <= r["bins_before"] for r in report)
    fill = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("o"))
    assert fill.where("n > 64 or o <> 0").count() == 0


def test_special_token_in_a_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    path, ranks = (str(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("json", "tiktoken"))
    tok, enc = Tokenizer.from_file(path), packing._Encoder(path, ranks)
    for t in ["a <|endoftext|> b", "  x\n\n y's  ", "naïve café 漢字 ½ \x1c.\x85", "", "\u2028\u00a0z 123abc"]:
        assert enc.encode([t])[0] == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_warc(spark, tmp_path):
    html = ["<p>a", "<p>a", "", None, "<p>b\r\n\r\nWARC/1.1", "ü" * 3000, "<p>a"]
    rows = [(i, f"http://x/{i}\n", h, "k") for i, h in enumerate(html)] + [(6, "u", "<p>a", "k"), (None, None, "<p>b\r\n\r\nWARC/1.1", "k")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    normal = warc.normalise(warc.write(d, size=2000))
    got = warc.read(normal).collect()
    last = {}
    for r in rows:
        if r[0] is not None:
            last[r[2] or ""] = max(last.get(r[2] or "", -1), r[0])
    want = Counter((r[0], len((r[2] or "").encode()), "response" if r[0] == last[r[2] or ""] else "revisit", None if r[0] == last[r[2] or ""] else last[r[2] or ""]) for r in rows)
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == want
    assert warc.read(warc.normalise(warc.write(d.limit(0)))).count() == 0
    warc.export(normal, str(tmp_path / "out"))
    import gzip

    files = sorted((tmp_path / "out").glob("*.warc.gz"))
    assert sum(gzip.open(f).read().count(b"WARC-Type: ") for f in files) == len(rows)


def _contained(doc, item):
    w, i = (words((t or "").lower()) for t in (doc, item))
    s = lambda x: Counter(tuple(x[k : k + 5]) for k in range(len(x) - 4)) if len(x) >= 5 else Counter([tuple(x)])
    best, own = 0.0, s(i)
    for a in range(max(1, len(w) - len(i) + 1)):
        x = s(w[a : a + len(i)])
        k = sum((x & own).values())
        best = max(best, k / (sum(x.values()) + sum(own.values()) - k))
    return best


def test_decontamination(spark, docs, none):
    rows = corpus()
    rnd = random.Random(8)
    item = words(rows[30][1])[10:60]
    bench = [(0, " ".join(item)), (1, "never seen words in any text of this corpus at all"), (2, ""), (3, None), (4, " ".join(words(rows[2][1])[:3])), (5, rows[50][1])]
    more = [(900 + k, " ".join([rnd.choice(item) for _ in range(20)] + item[: 50 - k] + ["zz"] * 30), None, None, None, None, None, None) for k in range(8)]
    d = docs.unionByName(spark.createDataFrame(more, DOCS))
    b = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(d, b).collect()}
    want = {}
    for r in [*rows, *more]:
        for i, t in bench:
            if words(t) and words(r[1]) and r[0] is not None and (s := _contained(r[1], t)) >= 0.8:
                want[(r[0], i)] = s
    got = {k: v for k, v in got.items() if k[0] is not None}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert decontaminate.matches(none, b).count() == 0
    assert decontaminate.matches(docs, b.limit(0)).count() == 0


def _vectors(seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(400, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * rng.uniform(0.1, 0.6, (60, 1))
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(np.concatenate([base, near, base[:5], base[:3] * 2]))]
    n = len(rows)
    return rows + [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [1.0] * 15 + [None], 1), (n + 3, [float("nan")] * 16, 1), (n + 4, [float("inf")] + [1.0] * 15, 1), (n + 5, [1.0, 2.0], 1), (None, rows[0][1], 1)]


def test_embeddings_by_brute_force(spark, monkeypatch):
    rows = _vectors()
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, list int").repartition(3)
    ok = [r for r in rows if r[0] is not None and r[1] and len(r[1]) == 16 and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    x = np.array([r[1] for r in ok])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = {(ok[i][0], ok[j][0]) for i, j in zip(*np.nonzero(x @ x.T >= 0.9), strict=True) if i != j}
    degree = Counter(u for u, _ in links)
    root = {r[0]: r[0] for r in rows}
    moved = True
    while moved:
        moved = False
        for u, v in links:
            if root[v] < root[u]:
                root[u], moved = root[v], True
    got = {r.vec_id: r for r in embeddings.near_vectors(d).collect()}
    assert len(got) == len(rows)
    assert {k: (r.n_links, r.component_id) for k, r in got.items()} == {r[0]: (degree[r[0]], root[r[0]]) for r in rows}
    monkeypatch.setattr(embeddings, "LIST", 16)  # many lists: probes decide
    few = {r.vec_id: r.n_links for r in embeddings.near_vectors(d, probes=12).collect()}
    assert sum(few.values()) >= 0.9 * sum(degree.values())
    assert all(few[k] <= degree[k] for k in few)
    assert embeddings.near_vectors(d.limit(0)).count() == 0


def _rounds(n, d, rng):
    x = rng.normal(size=(n, d))
    to = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    to -= (to * x).sum(axis=1, keepdims=True) * x
    to /= np.linalg.norm(to, axis=1, keepdims=True)
    return x, 0.91 * x + np.sqrt(1 - 0.91**2) * to


def test_embeddings_links_have_two_ends(spark, monkeypatch):
    x, y = _rounds(300, 32, np.random.default_rng(4))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y, y[:9]]))], "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(embeddings, "LIST", 16)
    monkeypatch.setattr(embeddings, "REACH", 0.0, raising=False)  # two probes: many pairs are found from one end only
    rows = embeddings.near_vectors(d, probes=2).collect()
    size = Counter(r.component_id for r in rows)
    assert sum(n > 1 for n in size.values()) > 100
    assert all(r.n_links == size[r.component_id] - 1 for r in rows)


def test_embeddings_probes_rise_until_pairs_are_reached(spark, monkeypatch):
    x, y = _rounds(600, 32, np.random.default_rng(5))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(embeddings, "LIST", 16)
    assert embeddings.near_vectors(d, probes=1).where("n_links > 0").count() >= 0.95 * 1200


def test_embeddings_link_in_every_dimension(spark):
    rng = np.random.default_rng(6)
    groups = [np.concatenate(_rounds(n, k, rng)) for n, k in ((90, 16), (60, 12), (5, 7))]  # 120 vectors train a quantiser, 10 do not
    rows = [v for g in groups for v in g.tolist()]
    d = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(3)
    near = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and len(rows[i]) == len(rows[j]) and np.dot(rows[i], rows[j]) >= 0.9 * np.linalg.norm(rows[i]) * np.linalg.norm(rows[j])}
    degree = Counter(i for i, _ in near)
    assert {r.vec_id: r.n_links for r in embeddings.near_vectors(d).collect()} == {i: degree[i] for i in range(len(rows))}


CLASH = ["row", "text_crc", "rid", "n_words", "n_removed", "kept", "kept_sha256", "places", "hit", "batch", "score", "label", "word", "bits", "marked", "key", "id", "digest", "item_id", "n_shingles", "component_id", "text_", "__old"]


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Documents with every awkward row, columns that clash with internal names, and their labels and benchmark."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(3000)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, item, base = say(60), say(40), say(150)
    texts = {i: say(rnd.randint(20, 120)) for i in range(200)}
    texts |= {i: f"{texts[i]} dreadful curse dreadful" for i in range(0, 60)}
    other = ["".join(rnd.choice("qrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
    long = " ".join(rnd.choice(other) for _ in range(400_000))  # 3 MB
    texts |= {200: None, 201: "", 202: " \t", 203: base, 204: base, 205: base.replace(" ", "\n", 1), 206: f"{say(30)} {passage} {say(9)}", 207: f"{passage} {say(40)}", 208: f"{say(20)} {item} {say(20)}", 209: passage, 210: long, 211: "x" * 300_000}
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in texts.items()] + [(203, base, "en", "src", len(base)), (None, say(50), None, None, None)]
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(7) for c in CLASH})
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 1) for i in range(150)] + [(0, None, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, (passage, item, base)


def test_pipeline_stage_by_stage(spark, odd_tables):
    import corpus_pipeline

    folder, texts, (passage, item, base) = odd_tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == names and docs.where(" or ".join(f"{c} <> 7" for c in CLASH)).count() == 0, name
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    tox, near, sub, clean = kept
    assert not {i for i in range(60)} & tox.keys() and {i for i in range(60, 212)} <= tox.keys() and None in tox
    # near copies: 203 stands for 204 and 205; nulls, empties and long texts stay
    assert tox.keys() - near.keys() == {204, 205} and docs.where("doc_id = 203").count() == 1
    # the passage is cut everywhere, and the document that is nothing else goes
    want = _cover([(i, t) for i, t in near.items()])
    assert near.keys() - sub.keys() == {209}
    got = Counter((i, len(words(near[i])), len(words(near[i])) - len(words(t)), hashlib.sha256(" ".join(words(t)).encode()).hexdigest()) for i, t in sub.items())
    assert got == Counter({k: n for k, n in want.items() if k[0] != 209})
    assert all(sub[i] == near[i] for i in sub if i not in (206, 207)) and passage not in sub[206]
    assert sub.keys() - clean.keys() == {208} and clean[200] is None and clean[201] == "" and clean[210] == texts[210]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == clean.keys()
    again = corpus_pipeline.run(spark, folder)
    assert {(p.doc_id, p.piece, p.length, p.ids_crc32) for p in again.collect()} == {(p.doc_id, p.piece, p.length, p.ids_crc32) for p in pieces}


def test_pipeline_of_nothing(spark, odd_tables, tmp_path):
    import corpus_pipeline

    folder, _, _ = odd_tables
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_chat(spark):
    rows = [
        (1, 0, "system", "be | \\ brief", 9), (1, 1, "user", "<|turn|>x<|text|>y<|end|>", 9), (1, 2, "assistant", "\\|<|end|>\\", 9), (1, 3, "user", None, 9), (1, 4, "assistant", "", 9),
        (2, None, None, "t", 9), (2, 1, "assistant", "ü\n\U0001f600" * 40, 9), (2, 1, "assistant", "tie", 9), (2, 1, "assistant", "tie", 9), (None, 0, "assistant", "lost", 9),
    ] + [(3, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i * 7 % 60), 9) for i in range(40)] + [(4, 0, "system", "s", 9), (4, 1, "assistant", "long " * 500, 9), (4, 2, "user", "u", 9), (4, 3, "assistant", "v", 9)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, span int")
    w = chat.windows(d, budget=120, history=2, history_tokens=40)
    made = w.collect()
    back = chat.read_back(w).collect()
    turns, loss = defaultdict(list), defaultdict(str)
    for r in sorted(back, key=lambda r: r.span):
        turns[r.conv_id] += [(t.role, t.text) for t in r.turns]
        loss[r.conv_id] += r.loss
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        assert turns[c] == [(r[2] or "", r[3] or "") for r in own]
        assert loss[c] == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert sum(r.conv_id == 3 for r in made) > 3 and any(r.repeated for r in made if r.conv_id == 3)
    assert all(r.text.startswith("<|turn|>system") for r in made if r.conv_id in (1, 4))
    for r in made:  # a window over the budget is one turn that is too long
        assert r.conv_id not in (3,) or len(re.findall(r"\w+|[^\w\s]", r.text)) < 400
    assert chat.windows(d.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    from strandloom.functions.components import components

    got = components(spark.range(1, 40).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))).collect()
    assert len(got) == 40 and all(r.component_id == 0 for r in got)
