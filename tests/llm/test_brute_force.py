"""Language, toxicity and the pipeline recomputed in plain Python; very long texts, empty tables, repeated rows and hot groups."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import bpe, chat, decontaminate, language, linededup, neardup, neighbours, simhash, tokenfile, toxicity


def softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def test_language_posterior(spark):
    """Each row's posterior from the definition: sums over all rows, less the row's own share."""
    rng = random.Random(4)
    words = {"en": "the cat and dog went with this house there".split(), "de": "der hund und die katze ging nicht nach haus".split(), "fr": "le chat et la maison sont dans une rue".split()}
    docs = [(i, " ".join(rng.choices(words[lang], k=8)), lang, "s") for i, lang in enumerate(sorted(words) * 12)]
    model = language.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"))
    rows = []
    for i in range(60):
        lang = rng.choice(sorted(words))
        host = rng.choice(["www.a.de", "b.a.de", "x.com", "y.com", "z.fr", ""])
        said = rng.choice([lang, lang, "", "en"])
        text = "" if i % 9 == 0 else " ".join(rng.choices(words[lang] + words["en"], k=rng.randint(1, 6)))
        rows.append((i % 50, f"http://{host}/p" if host else None, f'<html lang="{said}"><script>le la</script><p>{text}</p>'))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["row"], r["lang"], round(r["confidence"], 9)) for r in language.identify(language.evidence_of_pages(pages), model).collect())
    parts = []
    for i, url, page in rows:
        host = url.split("/")[2] if url else ""
        domain = ".".join(host.split(".")[-2:]) if "." in host else ""
        suffix = host.split(".")[-1] if "." in host else ""
        text = model.log_likelihood(page.split("<p>")[1].split("</p>")[0].encode())
        parts.append((i, (host, domain, suffix), page.split('"')[1], text, softmax(text)))
    n = len(model.languages)
    total = lambda keep: [sum(p[4][j] for p in parts if keep(p)) for j in range(n)]
    whole, kinds = total(lambda p: True), len({p[2] for p in parts})
    want = []
    for i, place, said, text, own in parts:
        prior = [(w + 1) / (sum(whole) + n) for w in whole]
        for level in (2, 1, 0):
            mine = [max(t - o, 0) for t, o in zip(total(lambda p, level=level: p[1][level:] == place[level:]), own, strict=True)]
            prior = [(m + language.STRENGTH * q) / (sum(mine) + language.STRENGTH) for m, q in zip(mine, prior, strict=True)]
        with_said = total(lambda p: p[2] == said)
        says = [math.log((max(a - o, 0) + language.ADDED) / (max(w - o, 0) + language.ADDED * kinds)) if said else 0 for a, w, o in zip(with_said, whole, own, strict=True)]
        after = softmax([t + s + math.log(q) for t, s, q in zip(text, says, prior, strict=True)])
        want.append((i, model.languages[after.index(max(after))], round(max(after), 9)))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in sorted(want)]
    assert np.allclose([c for *_, c in got], [c for *_, c in sorted(want)], atol=1e-6)


def test_language_held_out(spark):
    """Documents that the model has not seen, of the test tables."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = language.fit(docs.filter(fold != 0))
    found = language.identify(language.evidence_of_documents(docs.filter((fold == 0) & (F.length("text") > 40))), model).join(docs.select(F.col("doc_id").alias("row"), F.lower("lang").alias("said")), "row")
    right = found.agg(F.avg((F.col("lang") == F.col("said")).cast("int"))).first()[0]
    assert right >= 0.97


def test_ftrl_step_by_step():
    """The model against a dictionary of coordinates updated one by one."""
    rng = np.random.default_rng(6)
    rows = [(np.unique(rng.integers(0, 60, rng.integers(1, 12))).astype(np.int32), int(rng.random() < 0.4)) for _ in range(200)]
    rows += [(np.unique(np.r_[s, 3 if y else 5]).astype(np.int32), y) for s, y in rows]
    alpha, beta, l1, epochs = 1.0, 1.0, 5.0, 5
    z, n, zb, nb = {}, {}, 0.0, 0.0
    weight = lambda i: 0.0 if abs(z.get(i, 0.0)) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha)
    for _ in range(epochs):
        for slots, label in rows:
            w = {i: weight(i) for i in slots.tolist()}
            wb = -zb / ((beta + nb**0.5) / alpha)
            g = 1 / (1 + math.exp(-(wb + sum(w.values())))) - label
            for i, x in w.items():
                new = n.get(i, 0.0) + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(new) - math.sqrt(n.get(i, 0.0))) / alpha * x
                n[i] = new
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * wb
            nb += g * g
    model = toxicity.ftrl(list(rows), 8, alpha, beta, l1, 0.0, epochs)
    want = {i: weight(i) for i in z if weight(i)}
    assert set(model.slots.tolist()) == set(want) and 0 < len(want) < 60
    assert np.allclose(model.weights, [want[i] for i in model.slots.tolist()], atol=2e-3) and model.bias == pytest.approx(-zb / (beta + nb**0.5), abs=2e-3)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def roots(n, near):
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if root[i] != root[j] and near(i, j):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return root


def test_pipeline_against_brute_force(spark, tmp_path):
    """All five stages, one after the other, recomputed over a small corpus with planted cases."""
    import corpus_pipeline as pipe

    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijklmno", k=rng.randint(3, 8))) for _ in range(400)]
    line = lambda k=9: " ".join(rng.choices(vocabulary, k=k))
    common, text = line(), lambda k=4: "\n".join(line() for _ in range(k))
    docs = [text() for _ in range(40)]
    docs += [docs[1], docs[2].replace("\n", " "), "\n".join([common, line(), line()]), "\n".join([line(), common[:-1] + "zz"]), "\n".join([common, common]), "", None, "short\nshort"]
    words = line(60).split()
    docs += [" ".join(words), " ".join([*words[:30], "changed", *words[31:]]), " ".join([*words[:-1], "end"])]
    passage = line(12)
    docs += [f"{line(5)} {passage.upper()} {line(3)}", f"{line(4)}\n{passage} {line(2)}"]
    bad = "grumblefoo snarkbar"
    docs += [f"{line(6)} {bad} {line(4)} {bad}" for _ in range(40)]
    ids = list(range(len(docs)))
    toxic = {i: int(bad in (docs[i] or "")) for i in ids}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, docs, strict=True)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, line(11)), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in pipe.run(spark, str(tmp_path)).collect()}

    model = toxicity.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scorer = model.scorer()
    kept = {i: t for i, t in zip(ids, docs, strict=True) if scorer(t.encode() if t else None) < 0.5}
    assert not any(toxic[i] for i in kept) and len(kept) > 45
    places = [(i, k, x.strip()) for i, t in kept.items() for k, x in enumerate((t or "").split("\n")) if len(x.strip()) >= linededup.MIN_CHARS]
    near = lambda a, b: abs(len(places[a][2]) - len(places[b][2])) <= 2 and levenshtein(places[a][2], places[b][2]) <= linededup.MAX_EDITS
    gone = {places[k][:2] for k, r in enumerate(roots(len(places), near)) if r != k}
    lines = {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in kept.items()}
    lines = {i: t for i, t in lines.items() if not (t != kept[i] and not t.strip())}
    assert len(gone) >= 7 and len(lines) < len(kept)
    names = list(lines)

    def shingles(t):
        w = (t or "").lower().split()
        return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else None

    sets = [shingles(lines[i]) for i in names]
    alike = lambda a, b: sets[a] == sets[b] if not sets[a] or not sets[b] else len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    single = [names[k] for k, r in enumerate(roots(len(names), alike)) if r == k]
    assert len(single) < len(names)
    item = passage.lower().split()
    windows = {tuple(item[k : k + 10]) for k in range(3)}
    has = lambda t: any(tuple(w[k : k + 10]) in windows for w in [(t or "").lower().split()] for k in range(len(w)))
    clean = [i for i in single if not has(lines[i])]
    assert len(clean) < len(single)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i in clean:
        e = library.encode(lines[i] or "", add_special_tokens=False).ids
        want[i] = len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()
    assert got == want


def test_stages_take_odd_tables(spark, tmp_path):
    """Nulls in every column, repeated rows, extra columns with clashing names, and no rows at all."""
    import corpus_pipeline as pipe

    kind = "doc_id long, text string, lang string, source string, n_chars long, tie string, h string, lines string, score double, __x int"
    odd = [(1, "some words that make one line of a text here", None, None, None, "t", "h", "l", 0.1, 1)] * 2 + [(None, None, None, None, None, None, None, None, None, None), (None, "x", "en", "s", 1, "t", "h", "l", 0.1, 1), (2, "", "en", "s", 0, "t", "h", "l", 0.1, 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, kind)
        for name, stage in pipe.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == (list(pipe.COLUMNS) if name != "bpe" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            n = out.count()
            assert n == len(rows) if name in ("decontamination", "bpe") else n <= len(rows)
            assert n >= min(len(rows), 3) or name == "toxicity"


def test_very_long_texts(spark):
    """Texts of a million characters and more, in one row each, beside short ones."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    long = " ".join(rng.choices(words, k=200_000))
    lines = "\n".join(" ".join(rng.choices(words, k=8)) for _ in range(20_000))
    item = " ".join(long.split(" ")[150_000:150_012])
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, lines), (4, lines.split("\n")[19_990]), (5, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.digest(df, spark.createDataFrame([("a", item)], "item_id string, text string")).collect()}
    assert found[1]["n_words"] == 200_000 and found[1]["n_hit"] == found[2]["n_hit"] == 12 and not found[3]["contaminated"]
    prints = {r["doc_id"]: r["component_id"] for r in simhash.digest(df).collect()}
    assert prints[1] == prints[2] == 1 and prints[3] == 3
    assert {r["doc_id"] for r in neardup.one_of_each(df).collect()} >= {1, 3} and neardup.one_of_each(df).count() == 4
    removed = {r["doc_id"]: r["n_removed"] for r in linededup.digest(df).collect()}
    assert removed[4] == 1 and removed[3] == 0
    assert bpe.digest(df, public_tokenizers.path("byte_bpe_50k.json")).filter("n_tokens > 200000").count() == 3
    starts = [tuple(r) for r in tokenfile.digest(df, public_tokenizers.path("word_bpe_49k.json")).orderBy("doc_id").select("start", "n_tokens").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.digest(df, labels).filter("score BETWEEN 0 AND 1").count() == 5
    evidence = language.identify(language.evidence_of_documents(df.withColumn("source", F.lit("s"))), language.fit(df.withColumn("lang", F.lit("en"))))
    assert evidence.filter("lang = 'en'").count() == 5
    said = chat.digest(df.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("assistant").alias("role"), "text"))
    assert said.filter("conv_id = 1").first()["loss_chars"] == 2 * len(long) + 5 + len(lines) + len(lines.split("\n")[19_990])


def test_vectors_of_other_lengths_and_repeats(spark):
    """Each length is searched among its own; of rows with the same id and vector one counts."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(1000 + i, rng.standard_normal(5).tolist()) for i in range(120)] + [(2000, [1.0]), (2050, [2.0])]
    df = spark.createDataFrame(rows + rows[:40] + rows[300:340], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.digest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    by = dict(rows)
    for q in [i for i, _ in rows if i % 50 == 0]:
        others = [i for i, v in rows if i != q and len(v) == len(by[q])]
        score = lambda i, q=q: float(neighbours.cosine(np.float32([by[q]]).astype(float), np.float32([by[i]]).astype(float))[0, 0])
        want = sorted(others, key=lambda i: (-score(i), i))[:5]
        assert len(got[q]) == len(want) == len(set(got[q])) and (len(by[q]) == 8 or got[q] == want)
        assert all(len(by[i]) == len(by[q]) for i in got[q])


def test_empty_pages_and_hot_rows(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "s"), (1, "the cat", "en", "s")], "doc_id long, text string, lang string, source string")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert language.digest(docs, none).count() == 2
    hot = spark.createDataFrame([(i, "one very common line that all the documents of this source have") for i in range(500)], "doc_id long, text string")
    assert linededup.digest(hot).agg(F.sum("n_removed")).first()[0] == 499
    assert simhash.digest(hot).select("component_id").distinct().count() == 1 and neardup.one_of_each(hot).count() == 1


def test_pipeline_sends_small_batches_to_python(spark):
    """Rows reach Python in batches of about a megabyte, whatever their size, and a session's own bound stays."""
    import corpus_pipeline as pipe

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.getAll.get(key)
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("words "), 1000).alias("text"))

    def largest(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"n": pa.array([max(b.num_rows for b in batches)], pa.int64())})

    try:
        for own, most in ((None, 400), (str(1 << 30), 3000)):
            spark.conf.unset(key) if own is None else spark.conf.set(key, own)
            pipe.as_tokens(spark, docs, "")
            assert docs.mapInArrow(largest, "n long").first()["n"] <= most
            assert own is None or spark.conf.get(key).rstrip("b") == own
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)
