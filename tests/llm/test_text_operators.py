"""Decontamination, SimHash, line dedup and toxicity against brute force, with nulls, empties, ties and clashing names."""

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import decontaminate, linededup, neardup, simhash, toxicity
from weftline.session import shared_dir

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.3:
            del chars[at]
        elif kind < 0.6:
            chars.insert(at, "x")
        else:
            chars[at] = "z"
    return "".join(chars)


# Decontamination


def brute_hits(docs, items, size):
    windows = {}
    for i, t in items:
        found = WORD.findall(lower(t or ""))
        for k in range(max(1, len(found) - size + 1) if found and i is not None else 0):
            windows.setdefault(tuple(found[k : k + size]), set()).add(str(i))
    out = {}
    for d, t in docs:
        found, hit, some = WORD.findall(lower(t or "")), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(found) - n + 1):
                if tuple(found[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    some |= windows[tuple(found[k : k + n])]
        out[d] = (len(found), len(hit), sorted(some))
    return out


@pytest.mark.parametrize("block", [200_000, 12])
def test_decontamination(spark, block):
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice(["Alpha", "beta", "ünö", "42", "d-e"]) for _ in range(n))
    items = [(1, say(9)), (10, say(6)), (2, say(3)), (3, ""), (4, None), (None, say(5)), (5, "beta beta beta beta beta beta")]
    docs = [(i, say(rng.randint(0, 60))) for i in range(60)] + [(100, None), (101, ""), (102, "x " + items[0][1] + " y"), (103, "beta " * 12)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_items(decontaminate.build_index(d), b, size=4, block_words=block)
    got = {r["id"]: (r["n_words"], r["n"], r["items"]) for r in found.withColumn("n", decontaminate._hit_words("spans")).collect()}
    want = brute_hits(docs, items, 4)
    assert got == want
    kept = decontaminate.decontaminate(d.withColumn("tie", F.lit(1)).withColumn("id", F.lit(2)), b, size=4)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in want.items() if not v[1]) and kept.columns == ["doc_id", "text", "tie", "id"]


def test_proximity(spark):
    d = spark.createDataFrame([(1, "a x b c"), (2, "a b c"), (3, "a x x x b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    index = decontaminate.build_index(d)
    near = {r["id"]: [(s["a"], s["b"]) for s in r["spans"]] for r in decontaminate.find_items(index, b, slop=1).collect()}
    assert near == {1: [(0, 4)], 2: [(0, 3)], 3: []}


def test_decontamination_of_nothing(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(d, b).count() == 0
    assert decontaminate.digest(spark.createDataFrame([(1, "a")], d.schema), b).first()["contaminated"] is False


# SimHash


def brute_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not found:
        return 0
    shingles = [" ".join(found)] if len(found) < 3 else [" ".join(found[i : i + 3]) for i in range(len(found) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(80)) for _ in range(6)]
    docs = [(i, edited(rng, rng.choice(base), rng.choice([0, 1, 2]))) for i in range(90)] + [(200, None), (201, ""), (202, " \t "), (None, base[0]), (3, base[1]), (4, "One Two")]
    prints = [brute_fingerprint(t) for _, t in docs]
    roots = components(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for (d, _), r in zip(docs, roots, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    want = sorted((str(d), f"{p:016x}", str(least.get(r))) for (d, _), p, r in zip(docs, prints, roots, strict=True))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.digest(df).collect()) == want
    kept = simhash.one_of_each(df.withColumn("tie", F.lit(1)).withColumn("fp", F.lit(2)).withColumn("id", F.lit(3)))
    assert kept.count() == len(set(roots)) and kept.columns == ["doc_id", "text", "tie", "fp", "id"]
    assert simhash.digest(df.filter("false")).count() == 0


def test_links_in_large_keys():
    """Forests of large keys join what all pairs join; the pigeonring check never loses a link."""
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    flips = np.uint64(1) << rng.integers(0, 64, (300, 3)).astype(np.uint64)
    fps = np.unique(np.r_[centre, centre ^ flips[:, 0], centre ^ flips[:, 0] ^ flips[:, 1], centre ^ flips.T[0] ^ flips.T[1] ^ flips.T[2], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64))], ["fp"])
    keys = pa.Table.from_batches(list(simhash._probe([batch]))).sort_by("key").combine_chunks()
    edges = [e for b in simhash._meet(keys.to_batches(max_chunksize=700)) for e in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True)]
    place = {v: i for i, v in enumerate(fps.view(np.int64).tolist())}
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None]) <= 3)
    assert components(len(fps), [(place[a], place[b]) for a, b in edges]) == components(len(fps), near.tolist())


# Near-duplicates of the pipeline


@pytest.mark.parametrize("pairwise,block", [(24, 1024), (2, 3)])
def test_near_dedup_stage(spark, monkeypatch, pairwise, block):
    """The stage links what brute force over five-word shingles links, also texts whose fingerprints are many bits apart."""
    import corpus_pipeline

    monkeypatch.setattr(neardup, "_PAIRWISE", pairwise)
    monkeypatch.setattr(neardup, "_BLOCK", block)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(12):
        base = [*words[:12], *rng.choices(words, k=rng.randint(20, 200))]
        docs.append(base)
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(1, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(copy if rng.random() < 0.8 else copy[rng.randint(0, 12) :])
    docs = [(i, " ".join(w).upper() if i % 7 == 0 else "\n".join(w)) for i, w in enumerate(docs)]
    docs += [(200, None), (201, ""), (202, " \t "), (None, docs[0][1]), (3, docs[1][1]), (204, "one two three"), (205, "One  two three"), (206, "one two"), (207, "a b c d e"), (208, "b c d e a")]

    def grams(text):
        found = lower(text or "").split()
        return {" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    sets = [grams(t) for _, t in docs]
    near = lambda a, b: not (a | b) or 100 * len(a & b) >= 80 * len(a | b)
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if near(sets[i], sets[j])]
    far = [(i, j) for i, j in pairs if (simhash.fingerprint((docs[i][1] or "").encode()) ^ simhash.fingerprint((docs[j][1] or "").encode())).bit_count() > 3]
    assert len(far) > 20
    first = {}
    for (d, _), r in zip(docs, components(len(docs), pairs), strict=True):
        first[r] = min((d is None, d or 0), first.get(r, (True, 0)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    kept = corpus_pipeline.without_near_duplicates(spark, df, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for _, d in first.values()) and len(first) < len(docs) - 20
    assert corpus_pipeline.without_near_duplicates(spark, df.filter("false"), "").count() == 0


def test_near_dedup_disk(spark, monkeypatch):
    """Texts are read again only where sketches leave sets together, and what the stage writes on its way does not outlast it."""
    rng = random.Random(5)
    word = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]
    docs = []
    for _ in range(60):
        half = word(40)
        docs += [half + word(40), half + word(40)]
    docs += [docs[0][:-1], docs[2] + ["end"]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    rows, write = {}, neardup.written

    def counted(table, label, **more):
        out = write(table, label, **more)
        rows[label] = rows.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(neardup, "written", counted)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    kept = neardup.one_of_each(df)
    left = [x.name for x in set(folder.iterdir()) - before]
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(120))
    assert rows["near-texts"] == 4 and len(left) == 1 and left[0].startswith("weftline-near-shared")


def test_near_dedup_by_fingerprints(spark, monkeypatch):
    """Without prefixes the stage links what fingerprints of five-word shingles within three bits link and the exact check lets pass."""
    import corpus_pipeline

    rng = random.Random(9)
    docs = []
    for i in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        docs += [base, [*base[:150], *(f"x{rng.randrange(10**6)}" for _ in range(i % 4 + 1)), *base[150 + i % 4 + 1 :]]]
    docs = [" ".join(w) for w in docs] + ["a b c d e f", "a b c d e f g"]
    prints = [simhash.majority([neardup.shingles(t.encode())], len(neardup.shingles(t.encode()))) for t in docs]
    near = [i for i in range(0, 120, 2) if (prints[i] ^ prints[i + 1]).bit_count() <= simhash.MAX_DISTANCE]
    assert 10 < len(near) < 60
    monkeypatch.setattr(neardup, "_gather", lambda least: lambda batches: iter(()))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    kept = {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, df, "").collect()}
    assert set(range(122)) - kept == {i + 1 for i in near}
    # Fingerprints alone do not link: where all of them do, the exact check decides.
    monkeypatch.setattr(simhash, "links", lambda distinct: distinct.select(F.lit(7).cast("long").alias("u"), F.col("fp").alias("v")))
    kept = {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, df, "").collect()}
    assert kept == {*range(0, 120, 2), 120, 121}


def test_sketches_never_part_near_sets():
    """Sketches, folded to the smaller, differ in no more bits than their sets in elements."""
    rng = np.random.default_rng(6)
    for n in (1, 2, 8, 9, 60, 64, 65, 700):
        base = rng.integers(0, 1 << 64, n, np.uint64)
        for gone in {0, 1, n // 9, n // 2}:
            other = np.unique(np.r_[base[gone:], rng.integers(0, 1 << 64, n // 3, np.uint64)])
            a, b = neardup._sketch(np.unique(base)), neardup._sketch(other)
            size = min(len(a), len(b))
            assert np.bitwise_count(neardup._folded(a, size) ^ neardup._folded(b, size)).sum() <= len(np.setxor1d(base, other))


# Line dedup


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choices("abé", k=rng.randint(1, 14)))
        b = edited(rng, a, min(len(a) - 1, rng.randint(0, 4))) if len(a) > 1 else a
        for limit in (1, 2, 3):
            assert linededup.within(a, b, limit) == (levenshtein(a, b) <= limit)


@pytest.mark.parametrize("limit", [1, 2])
def test_segments_meet(limit):
    """Two lines within the limit share a key, one of them indexed and the other probing or indexed."""
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choices("abcd", k=rng.randint(7, 15)))
        b = edited(rng, a, limit)
        keys = lambda s, probe: {(n, i, s[x:y]) for n, i, x, y, p in linededup._plan(len(s), limit) if p <= probe}
        assert a == b or keys(a, True) & keys(b, False) or keys(b, True) & keys(a, False)


@pytest.mark.parametrize("limit,block", [(1, 2048), (2, 3)])
def test_line_dedup(spark, monkeypatch, limit, block):
    monkeypatch.setattr(linededup, "_BLOCK", block)
    rng = random.Random(6)
    base = [" ".join(rng.choice(["alpha", "beta", "gämma", "delta"]) for _ in range(8)) for _ in range(25)]
    rows = [(d, "\n".join([*[edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 5))], "short"])) for d in range(50)]
    rows += [(None, base[0]), (100, None), (101, ""), (5, rows[5][1]), (102, "  " + base[1] + " \n" + base[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tie", F.lit(1)).withColumn("lines", F.lit(2)).withColumn("n_lines_removed", F.lit(-1))
    ties = {(r["doc_id"], r["text"]): r["x"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("x")).collect()}
    places = sorted({((d is None, d or 0), ties[d, t], n, line.strip()) for d, t in rows for n, line in enumerate((t or "").split("\n")) if len(line.strip()) >= 30})
    lines = sorted({p[3] for p in places})
    roots = components(len(lines), [(i, j) for i in range(len(lines)) for j in range(i) if levenshtein(lines[i], lines[j]) <= limit])
    cls, seen, gone = dict(zip(lines, roots, strict=True)), set(), set()
    for p in places:
        if cls[p[3]] in seen:
            gone.add(p[:3])
        seen.add(cls[p[3]])
    want = sorted(str((d, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if ((d is None, d or 0), ties[d, t], n) not in gone))) for d, t in rows)
    out = linededup.dedup_lines(df, limit)
    assert sorted(str((r["doc_id"], r["text"])) for r in out.collect()) == want and len(gone) > 40
    assert linededup.digest(df.filter("false").select("doc_id", "text")).count() == 0


def test_lines_two_edits_apart_are_repeats(spark):
    """Without a threshold given, two replaced, added or lost characters make no new line; four do."""
    line = "the quick brown fox jumps over the lazy dog"
    rows = [(1, line), (2, line.replace("quick", "quack").replace("dog", "dig")), (3, line[2:] + "\nkept"), (4, line.replace("lazy", "grim"))]
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: line, 2: "", 3: "kept", 4: rows[3][1]}


# Toxicity


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    docs, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = [word() for _ in range(rng.randint(5, 60))]
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "awful"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(bad) if i % 50 else None))
    docs += [(700, None), (701, ""), (None, "vile"), (3, "vile again")]
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (1, 1), (1, 0)], "doc_id long, toxic int")
    got = {(r["doc_id"], t): r for r, (_, t) in zip(toxicity.digest(d, y).collect(), docs, strict=True)}
    assert len(got) == len(docs)
    held = [(r, i) for (i, _), r in got.items() if i is not None and i < 600 and r["held_out"]]
    assert all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for (i, _), r in got.items())
    assert np.mean([r["predicted"] == int(i % 5 == 0) for r, i in held]) > 0.97
    assert got[700, None]["score"] == got[701, ""]["score"] and 0 <= got[700, None]["score"] < 0.5
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in got.values())
    again = toxicity.fit(d.repartition(7), y.repartition(3))
    first = toxicity.fit(d, y)
    assert again.slots.tolist() == first.slots.tolist() and again.bias == pytest.approx(first.bias)
    assert len(first.slots) < 200


def test_toxicity_without_labels(spark):
    d, y = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.digest(d, y).collect()} == {0.5}
    assert toxicity.digest(d.filter("false"), y).count() == 0


@pytest.mark.parametrize("long", [50, 1 << 16])
def test_line_keys_are_made_in_arrays(monkeypatch, long):
    """Keys agree where the stretches that a line indexes or probes do, whatever lines come with it, and only long lines are hashed stretch by stretch."""
    rng, calls = random.Random(4), []
    hashing = linededup.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(linededup, "_LONG", long)
    monkeypatch.setattr(linededup, "xxhash", type("Counted", (), {"xxh3_64_intdigest": staticmethod(lambda *a: calls.append(1) or hashing(*a))}))
    lines = []
    for alphabet, n in [(a, n) for a in ("ab", "a\u00e9\u6f22", "b\U0001f600") for n in (30, 33, 49, 50, 51, 52, 53, 60, 300)]:
        one = "".join(rng.choices(alphabet, k=n))
        lines += [one, one[1:] + "a", one[:7] + "b" + one[7:], one[:-2]]
    lines, found = [x.encode() for x in lines if len(x) >= 30], {}
    keys = linededup._Keys(2)
    for some, points, bounds in linededup._blocks(lines):
        key, line, probing = keys(points, bounds)
        for k, i, p in zip(key.tolist(), line.tolist(), probing.tolist(), strict=True):
            found.setdefault(int(some[i]), []).append((k, p))
        classes = np.stack([np.bincount([ord(c) & 7 for c in lines[i].decode()], minlength=8) for i in some.tolist()]) % 256
        assert (linededup._sketches(points, bounds).view(np.uint8).reshape(-1, 8) == classes).all()
    of, back = {}, {}
    for i, line in enumerate(lines):
        text = line.decode()
        plan = linededup._plan(len(text), 2)
        assert [bool(p) for _, p in found[i]] == [p for *_, p in plan]
        for (other, segment, a, b, _), (k, _) in zip(plan, found[i], strict=True):
            assert of.setdefault((other, segment, text[a:b]), k) == k and back.setdefault(k, (other, segment, text[a:b])) == (other, segment, text[a:b])
    assert bool(calls) == (long == 50)
