"""The pipeline's stages on a small table with planted copies, passages and noise."""

import itertools
import re

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from arcloom.llm import decontaminate, language_id

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data"))
    rows = duckdb.sql(f"select * from '{DATA}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{DATA}/benchmark.parquet' order by item_id").fetchall()
    own = next(r for r in rows if r[2] == "en" and 300 < len(r[1]) < 2000)
    other = [r for r in rows if r[2] == "en" and 2000 < len(r[1]) < 9000][0]
    extra = [(9001, own[1].replace(" ", "  "), "en", "s"), (9002, own[1] + " tail", "en", "s"), (9003, "12 34 !!", "en", "s"), (9004, None, None, "s"),
             (9005, other[1] + "\n" + items[0][1], "en", "s"), (9006, items[1][1], "en", "s")]
    spark.createDataFrame([*rows, *[(*e, len(e[1] or "")) for e in extra]], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, own, items


def test_stages(spark, planted):
    path, own, items = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    before, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "sentencepiece":
            assert docs.columns == before
        if name == "decontaminate":
            bench = spark.createDataFrame(items, "item_id long, text string")
            assert decontaminate.find_hits(docs, bench).where("n_hit > 0").count() == 0
    assert not {9003, 9004} & seen["language_id"] and {9001, 9002, 9005} <= seen["language_id"]
    assert 9001 not in seen["exact_dedup"] and 9002 in seen["exact_dedup"] and 9002 not in seen["jaccard_join"]
    assert 9006 not in seen["decontaminate"]
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in docs.collect())


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_copies(rows):
    least = {}
    for i, t in rows.items():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        least[key] = min(least.get(key, i), i)
    return {i: rows[i] for i in least.values()}


def brute_near(rows, k=5, percent=80):
    sets = {}
    for i, t in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    comp = {i: i for i in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in itertools.combinations(sorted(rows), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            comp[max(root(a), root(b))] = min(root(a), root(b))
    return {i: t for i, t in rows.items() if root(i) == i}


def brute_clean(rows, items, n=10):
    windows = set()
    for _, t in items:
        w = WORD.findall(ascii_lower(t))
        windows |= {tuple(w[a : a + n]) for a in range(max(len(w) - n, 0) + 1)} if w else set()
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in rows.items():
        first = True
        while True:
            found = list(WORD.finditer(ascii_lower(t)))
            w = [m.group() for m in found]
            hit = {x for m in sizes for a in range(len(w) - m + 1) if tuple(w[a : a + m]) in windows for x in range(a, a + m)}
            if first and len(hit) > len(w) / 2:
                break
            if not hit:
                out[i] = t
                break
            first, kept, at = False, [], 0
            for x in sorted(hit):
                if x - 1 not in hit:
                    kept.append(t[at : found[x].start()])
                at = found[x].end()
            t = "".join([*kept, t[at:]])
    return out


def test_rows_against_brute_force(spark, planted):
    """What language identification keeps goes through the other stages; ids and texts are held against plain Python."""
    path, _, items = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        out.write.parquet(f"{path}/brute-{name}")
        docs = spark.read.parquet(f"{path}/brute-{name}")
        if name == "sentencepiece":
            assert {r["doc_id"]: list(r["ids"]) for r in docs.collect()} == {i: model.encode(t) for i, t in want.items()}
            continue
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        want = {"language_id": lambda x: got, "exact_dedup": brute_copies, "jaccard_join": brute_near, "decontaminate": lambda x: brute_clean(x, items)}[name](want)
        assert got == want, name


def test_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert 0.7 * n < out.count() < n


def test_empty(spark, planted, tmp_path):
    path = planted[0]
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{path}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_of_several_languages_stay(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["lang"]: r["text"] for r in docs.where("length(text) between 2000 and 9000").dropDuplicates(["lang"]).collect()}
    langs = sorted(texts)[:4]
    mixed = " ".join(texts[x][:n].rsplit(" ", 1)[0] for x, n in zip(langs, (700, 600, 600, 600)))
    rows = [(9101, mixed, langs[0], "s", len(mixed)), (9102, "12 34 !!", langs[0], "s", 8), (9103, None, None, "s", 0)]
    odd = spark.createDataFrame(rows, docs.schema)
    model = language_id.train(docs)
    label = {r["doc_id"]: r for r in language_id.label(odd, model).collect()}
    assert len(langs) == 4 and label[9101]["lang_pred"] != language_id.UNKNOWN and 0 < label[9101]["score"] < 0.5
    kept = corpus_pipeline.identify(spark, docs.unionByName(odd), str(tmp_path))
    assert {r["doc_id"] for r in kept.where("doc_id > 9100").collect()} == {9101}
