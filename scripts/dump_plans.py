"""Write the formatted physical plan of each headline query to docs/plans.md
(executed first, so the adaptive plan shown is the final one)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from encore import registry  # noqa: E402
from encore.session import local_session  # noqa: E402

NAMES = ["song_features", "song_rsi", "song_rsi_top30", "singer_rsi", "user_login_detail", "user_single_login",
         "machine_base_info", "log_request_routing", "date_window_filter"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores="8", shuffle_partitions=16)
    out = ["# Physical plans (sf0.01, local[8]; AQE may still switch join strategies at run time)\n",
           "Generated by `python scripts/dump_plans.py`.\n"]
    for n in NAMES:
        df = registry.QUERIES[n](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        out.append(f"\n## {n}\n\n```\n{plan}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.md"), "w") as f:
        f.write("".join(out))


if __name__ == "__main__":
    main()
