"""Print the final (post-AQE) physical plans of the headline queries, trimmed, for PLANS.md.
usage: python tools/plans.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import re
import sys
import uuid

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from ranklight.operators import features, indexing, neighbours, ranking  # noqa: E402
from ranklight.session import checkpoint_dir, get_session  # noqa: E402
from ranklight.sources import index_store  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|WindowGroupLimit|Window|HashAggregate|Scan parquet|FileScan|MapInArrow|"
                  r"FlatMapCoGroups|Generate|Broadcast|dynamicpruning|Subquery|Sort |TakeOrdered|AQEShuffleRead)")


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def compact(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line) and "Initial Plan" not in line:
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"INSET [^)]*\)", "INSET <stop list>)", line)
            line = re.sub(r"regexp_replace\(.*\), \d+\)", "<tokeniser>", line)
            out.append(line[:width])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    read = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    docs, emb = read("documents"), read("embeddings")
    bench = read("benchmark").select(F.col("item_id").alias("query_id"), "text")
    path = f"{checkpoint_dir(spark)}/ranklight/plans-{uuid.uuid4().hex}"
    index_store.save_index(indexing.build_index(docs), path)
    saved = index_store.load_index(spark, path)
    emb_q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    cases = [
        ("Cosine search, one query, saved index (M3)", ranking.cosine_search(saved, ranking.single_query(spark, "sun sea and sand"), 10)),
        ("Cosine search, all benchmark queries, saved index (M4)", ranking.cosine_search(saved, bench, 10)),
        ("Exact kNN, all vectors, broadcast query batch (M8)", neighbours.knn(emb, emb_q, 5)),
        ("Exact kNN, blocked strategy (M8, salted cogroup)", neighbours.knn(emb, emb_q, 5, block_rows=128)),
        ("Grid radius search (M11)", neighbours.grid_within(emb, emb_q, 1.2)),
        ("Signal features (M17)", features.signal_features(read("events"), "user_id", ["ts", "event_id"], "value", 8, 6, 10)),
    ]
    print("# PLANS — final physical plans (after AQE) of the headline queries\n")
    print(f"Generated by `python tools/plans.py {sf}`; operator lines only (projections and codegen stages "
          "dropped, ids stripped, the tokeniser and stop list abbreviated).\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{compact(final_plan(df))}\n```\n")


if __name__ == "__main__":
    main()
