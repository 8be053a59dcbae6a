"""Every stage of the pipeline against a plain version of it, on the stage's own input."""

import corpus_pipeline as P
import public_tokenizers
import sentencepiece
from test_decontaminate import brute as contaminated
from test_jaccard_join import brute as components
from test_suffix_dedup import brute as without_repeats
from tessera.plans import write_through

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, documents, awkward):
    extra = awkward.where("doc_id > 1").selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "_text AS source",
                                                   "CAST(length(text) AS bigint) AS n_chars")
    docs = documents.unionByName(extra)
    assert [n for n, _ in P.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "sentencepiece"]
    steps = [docs]
    for _, stage in P.STAGES:
        steps.append(write_through(stage(spark, steps[-1], SF)))
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    before, judged, single, cut, clean, coded = steps
    assert sorted(pairs(judged)) == sorted((d, t) for d, t in pairs(before) if any(c.isalpha() for c in t))
    keep = {r[2] for r in components(pairs(judged), 5, 80)}
    # rows equal in id and text are one document
    assert sorted(pairs(single)) == sorted({(d, t) for d, t in pairs(judged) if d in keep})
    left = {r[0]: r[5].decode("utf-8", "ignore") for r in without_repeats(pairs(single)) if r[2] == 0 or r[2] < r[1]}
    assert dict(pairs(cut)) == left and cut.count() == len(left)
    assert cut.where("n_chars != length(text)").count() == 0
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(pairs(cut), items) if r[2]}
    assert bad and sorted(pairs(clean)) == sorted((d, t) for d, t in pairs(cut) if d not in bad)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: sp.encode(t) for d, t in pairs(clean)}
    got = {r.doc_id: r for r in coded.collect()}
    assert set(got) == set(want)
    assert all(got[d]["ids"] == ids and got[d].decoded == sp.decode(ids) and got[d].n_tokens == len(ids)
               for d, ids in want.items())


def test_run_is_the_stages(spark, documents):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and 50 < out.count() < documents.count()


def test_empty_table(spark, documents):
    docs = documents.limit(0)
    for _, stage in P.STAGES:
        docs = write_through(stage(spark, docs, SF))
    assert docs.count() == 0
