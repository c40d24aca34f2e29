"""The whole pipeline against a brute-force version of its stages on a small corpus."""

import random
import zlib

import numpy as np

import corpus_pipeline
from roadloom.llm import language_id, ngram_join, packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(11)
    parts = {"aa": ["ka", "ko", "ki", "tra"], "bb": ["zu", "ze", "xo", "vre"]}

    def prose(lang, n):
        return ["".join(rng.choices(parts[lang], k=4)) for _ in range(n)]

    items = [(i, " ".join(prose(("aa", "bb")[i % 2], 20))) for i in range(4)]
    texts = []
    for i in range(120):
        lang = ("aa", "bb")[i % 2]
        w = prose(lang, rng.randrange(30, 90))
        if i % 10 == 3:
            w[7:7] = items[i % 4][1].split()
        if i % 10 == 6:
            w[5:5] = ["password", "=", "hunter22"]
        texts.append((" ".join(w), lang))
    texts += [texts[k] for k in (0, 1, 3, 6)] + [(texts[20][0] + " kako", "aa"), (" ".join(prose("bb", 5000)), "bb")]
    texts += [(None, "aa"), ("", None), ("12 34 --", "bb")]
    return [(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)], items


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, items = _corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # The language model is learned; which rows it names is taken from it, and that it loses none of the prose is held here.
    known = {r.doc_id for r in language_id.identify(docs).collect() if r.lang_pred != "und" and not r.ambiguous}
    assert known == {d for d, t, *_ in rows if any(c.isalpha() for c in t or "")}
    left = [(d, t) for d, t, *_ in rows if d in known]

    sets = [set(ngram_join.shingles(t).tolist()) for _, t in left]
    up = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(up[i], up[j]), min(up[i], up[j])
                up = [new if u == old else u for u in up]
    unique = [x for i, x in enumerate(left) if up[i] == i]

    def phrases(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    clean = [(d, t) for d, t in unique if not any(len(phrases(x) & phrases(t)) >= 0.8 * len(phrases(x)) for _, x in items)]
    assert len(rows) > len(left) > len(unique) > len(clean) > 90

    t, want = Tokenizer.from_file(packing.default_vocabulary()), []
    for d, text in clean:
        ids = np.array([*t.encode(text.replace("password = hunter22", "<assign>"), add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(d, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)

    end: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 2048


def test_stages_on_odd_rows(spark, tmp_path):
    rows, items = _corpus()
    rows = [(d, t, lang, s, n, "k", "w", 1) for d, t, lang, s, n in rows[:60]]
    rows += [(None, "zuzexovre zezexozu " * 30, "bb", None, None, None, None, None), (None, "zuzexovre zezexozu " * 30, "bb", None, None, None, None, None), (2, None, None, None, None, None, None, None)]
    # names that stages use for themselves
    docs = spark.createDataFrame(rows, SCHEMA + ", _k string, _language string, spans int")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    first = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert first.filter("doc_id is null").count() == 2 and first.filter("text is null").count() == 0
    assert corpus_pipeline.join_ngrams(spark, first, str(tmp_path)).filter("doc_id is null").count() == 1
    assert corpus_pipeline.pack(spark, docs, str(tmp_path)).filter("doc_id is null").count() >= 2


def test_empty_documents_and_benchmark(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
