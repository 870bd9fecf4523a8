"""The pipeline's stages one after the other, against plain readings of what each keeps."""

import brute_llm as brute
import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        out = stage(spark, docs, SF).cache()
        after = {r.doc_id: r for r in out.collect()}
        ids = {i for i, _, _ in before}
        assert set(after) <= ids and len(after) == out.count()
        if name != "mixing":
            assert out.columns == names
        if name == "quality_rules":
            for i, text, _ in before:
                n, _, _, _, rep = brute.quality(text)
                assert i not in after or not (n < 20 or 100 * rep > 30 * n)
        elif name == "near_duplicates":
            label = brute.near_components([brute.fingerprint(t) for _, t, _ in before])
            least = {}
            for (i, _, _), c in zip(before, label, strict=True):
                least[c] = min(least.get(c, i), i)
            assert set(after) == set(least.values())
        elif name == "decontamination":
            assert set(after) == ids - {d for d, _ in brute.overlaps([(i, t) for i, t, _ in before], bench)}
        elif name == "pii":
            assert set(after) == ids and not any(brute.pii(r.text) for r in after.values())
            assert all(after[i].text == t for i, t, _ in before if not any(c.isdigit() for c in t))
        else:
            assert set(after) == ids
            assert all(after[i]["size"] == len(brute.spaced(t.encode())) for i, t, _ in before)
        docs = out


def test_rows_without_anything(spark):
    """A pipeline over no documents gives no rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
