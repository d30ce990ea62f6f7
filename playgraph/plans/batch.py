"""Ingest once, report many: the batch job a deployment schedules.

The canonical tables are written once as Parquet under the shared
checkpoint folder (``spark.checkpoint.dir`` on a cluster) and read back, so
every report starts from stored files: lineage is cut, a lost executor
recomputes at most one report stage, and the document parsing is not
repeated per report.  The library and friend lists are stored sorted by
account inside each file, so per-account reads touch few row groups.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from playgraph.operators import library as lib_ops
from playgraph.operators import network, profile as profile_ops, recommend as rec, status
from playgraph.session import materialize


def run_reports(
    spark: SparkSession,
    library: DataFrame,
    friend_edge: DataFrame,
    profile: DataFrame,
    accounts: DataFrame,
    out_dir: str,
    owned: DataFrame | None = None,
    table_root: str | None = None,
) -> dict[str, str]:
    """Materialize the canonical tables, then write every per-account report.

    Returns report name -> output path.
    """
    lib = materialize(library, "library", table_root, ["account_id", "pos"])
    edges = materialize(friend_edge, "friend_edge", table_root, ["account_id", "pos"])
    prof = materialize(profile, "profile", table_root, ["account_id"])
    own = lib if owned is None else materialize(owned, "owned", table_root, ["account_id"])
    reports = {
        **rec.both_sweeps(lib, edges, prof, own, lambda df, name: materialize(df, name, table_root)),
        "friends_used": rec.friends_used(edges, prof),
        "friend_network": network.friend_network(edges, prof),
        "profile_summary": profile_ops.profile_summary(prof),
        "library_top15": lib_ops.library_top(lib),
        "most_played": lib_ops.most_played(lib),
        "account_status": status.account_status(accounts, prof, lib, edges),
    }
    paths = {}
    for name, df in reports.items():
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
