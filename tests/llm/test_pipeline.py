import corpus_pipeline
from llm_tools import SF, duck
from tidemark.llm.oracles import OP1, OP2, OP4, OP10


def test_stages_equal_their_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_join", "decontamination", "mixing", "token_files"]
    benchmark = {"benchmark": f"{SF}/benchmark.parquet"}

    def rows(sql, before):
        columns, found = duck(sql, {"documents": before.toPandas(), **benchmark})
        return [dict(zip(columns, r)) for r in found]

    def ids(df):
        return sorted(r["doc_id"] for r in df.collect())

    good = stages["quality_rules"](spark, docs, SF)
    assert ids(good) == sorted(int(r["doc_id"]) for r in rows(OP4, docs) if r["kept"] == "True")
    single = stages["ngram_join"](spark, good, SF)
    assert ids(single) == sorted(int(r["doc_id"]) for r in rows(OP1, good) if r["doc_id"] == r["component_id"])
    clean = stages["decontamination"](spark, single, SF)
    assert ids(clean) == sorted(int(r["doc_id"]) for r in rows(OP10, single) if r["contaminated"] == "False")
    mixed = stages["mixing"](spark, clean, SF)
    assert ids(mixed) == sorted(int(r["doc_id"]) for r in rows(OP2, clean) for _ in range(int(r["copies"])))
    assert all(df.columns == docs.columns for df in (good, single, clean, mixed))
    tokens = stages["token_files"](spark, mixed, SF)
    assert ids(tokens) == ids(mixed)
    assert sorted(map(tuple, tokens.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
