"""Write the physical plans of the headline queries (explain 'formatted')
to PLANS.md, keeping the lines that show scans, pushed filters, exchanges,
joins and limits.

usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.operators import corpus, dense, lexical  # noqa: E402
from tessera.functions.text import word_tokens  # noqa: E402
from tessera.plans import catalog_dense  # noqa: E402
from tessera.plans.engine import as_queries  # noqa: E402
from tessera.session import get_spark, scratch_path  # noqa: E402
from tessera.sources.tables import benchmark_queries, documents, table  # noqa: E402

KEEP = re.compile(r"^\(\d+\) |PushedFilters|PartitionFilters|ReadSchema|Location|Join type|Join condition|"
                  r"Arguments|Keys|Functions")


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    kept = [ln for ln in details.splitlines() if KEEP.search(ln)]
    return tree.strip() + "\n\n" + "\n".join(kept[:80])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    root = scratch_path(spark, "plans")
    coll = lexical.Collection(documents(spark, sf))
    lexical.save_lexical(lexical.build_lexical(coll, "bm25"), f"{root}/bm25")
    bm = lexical.load_lexical(spark, f"{root}/bm25", "bm25")
    items = []
    items.append(("BM25 batch search over the persisted index: postings and queries meet in cells (no pair of query and text is exchanged)",
                  lexical.search(bm, benchmark_queries(spark, sf), 10, fill_zero=False)))
    items.append(("BM25 small-batch search: bucket folders pruned by the batch's terms",
                  lexical.search(bm, as_queries(spark, ["the worthless of"]), 10, fill_zero=False)))
    items.append(("Term counts (E1): counted inside the row, no exchange",
                  coll.tokens.select("doc_id", "tokens").transform(
                      lambda t: __import__("tessera.operators.stats", fromlist=["x"]).term_counts(t))))
    items.append(("Level counts (E6): GROUPING SETS over pre-aggregated counts",
                  corpus.level_counts(corpus.group_counts(table(spark, sf, "documents"), "lang", "source",
                                                          word_tokens("text")))))
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    items.append(("Cosine top-k (D4): items and queries dealt into cells, group limit per query",
                  dense.cosine_topk(emb.withColumnRenamed("embedding", "vec"),
                                    catalog_dense.query_vectors(spark, sf), 10, "vec_id")))
    out = ["# Physical plans of headline queries", "",
           f"Generated by `tools/show_plans.py` on `{sf}` (Spark {spark.version}, AQE on; "
           "AQE may still switch join strategies at run time).", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
