from pyspark.sql import functions as F

import corpus_pipeline
from appraise.llm import quality, tables
from tests.llm import helpers
from tests.llm.helpers import ALNUM_WORDS, edited, low, text_of


def corpus(spark, tmp_path):
    """documents, labels and benchmark as Parquet: clean texts, junk, copies, near copies, a shared line, a test item."""
    item = text_of(24, 4242)
    docs, labels = [], []
    for i in range(60):
        lines = [text_of(14, 7000 + 20 * i + k, 10 ** 6) + "." for k in range(6)]
        docs.append((i, "\n".join(lines)))
    docs += [(60 + i, docs[i][1]) for i in range(5)]
    docs += [(70 + i, edited(docs[10 + i][1].replace("\n", " "), 0.01, i)) for i in range(5)]
    docs += [(80 + i, "\n".join([text_of(60, 8000 + i, 10 ** 6), "the very same line in many texts here", text_of(30, 8500 + i, 10 ** 6)])) for i in range(8)]
    docs += [(90 + i, text_of(40, 9000 + i, 10 ** 6) + "\n" + item + "\n" + text_of(40, 9500 + i, 10 ** 6)) for i in range(3)]
    docs += [(100 + i, "\n".join(" | ".join(f"MENU{(i * 31 + k * 7 + j) % 997}!!" for j in range(12)) + " ### $$$" for k in range(6))) for i in range(30)]
    docs += [(200, None), (201, ""), (202, "short"), (None, text_of(70, 99, 10 ** 6)), (3, docs[3][1])]
    labels += [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(25)]
    made = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", made), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
                     ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return docs, item


def test_stages_on_their_own_inputs(spark, tmp_path):
    docs, item = corpus(spark, tmp_path)
    at, columns = tables.table(spark, str(tmp_path), "documents"), None
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or at.columns
        out = tables.written(stage(spark, at, str(tmp_path)), f"test-{name}")
        if name != "bpe":
            assert out.columns == columns
        seen[name] = ([tuple(r)[:2] for r in at.collect()], [tuple(r) for r in out.collect()])
        at = out
    ids = {n: sorted({r[0] for r in v[1] if r[0] is not None}) for n, v in seen.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    # junk and short texts go, clean texts stay, the null id too
    assert ids["quality_rules"] == [i for i, _ in sorted({d[0]: d for d in docs if d[0] is not None}.items()) if i < 100]
    assert any(r[0] is None for r in seen["quality_rules"][1])
    # a copy keeps no line and goes; a shared line stays in one place; n_chars follows
    lined = {r[0]: r for r in seen["line_dedup"][1]}
    assert not set(range(60, 65)) & set(lined) and sum("very same line" in r[1] for r in lined.values()) == 1
    assert all(r[4] == len(r[1]) for r in lined.values())
    # one of each group
    near = ids["near_duplicates"]
    assert len(seen["near_duplicates"][1]) == len(near) + 1 and not set(range(70, 75)) & set(near) and set(range(60)) <= set(near)
    # no text shares ten words with the item
    wins = {tuple(w) for v in [ALNUM_WORDS.findall(low(item))] for w in (v[p:p + 10] for p in range(len(v) - 9))}
    for _, t, *_ in seen["decontamination"][1]:
        w = ALNUM_WORDS.findall(low(t))
        assert not any(tuple(w[p:p + 10]) in wins for p in range(len(w) - 9))
    assert set(near) - set(ids["decontamination"]) == {90}  # the other two lost the item's line to the first
    # the last stage changes no text
    assert sorted((r[0], r[1]) for r in seen["bpe"][1] if r[0] is not None) == sorted((r[0], r[1]) for r in seen["decontamination"][1] if r[0] is not None)


def test_run_and_empty_documents(spark, tmp_path):
    for name, kind in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"),
                       ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "text", "ids", "n_tokens"} <= set(out.columns)
    assert quality.train(tables.table(spark, str(tmp_path), "documents"), tables.table(spark, str(tmp_path), "labels")) is None
    assert helpers.components(3, [(0, 2)]) == [0, 1, 0]


def test_stages_keep_columns_with_inner_names(spark, tmp_path):
    corpus(spark, tmp_path)
    names = ["__text", "__key", "__drops", "key", "ids_", "kept"]
    docs = tables.table(spark, str(tmp_path), "documents").select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.written(stage(spark, docs.withColumns({"ids": F.lit("x"), "n_tokens": F.lit("y")}) if name == "bpe" else docs, str(tmp_path)), f"names-{name}")
        rows = docs.select("doc_id", *names).collect()
        assert rows and all(r[n] == f"{n}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in names)
    assert dict(docs.dtypes)["ids"] == "array<int>" and dict(docs.dtypes)["n_tokens"] == "bigint"
