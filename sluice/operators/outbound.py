"""Outbound file content checks (SRC-5, PRJ-1/2, JOIN-3, AGG-7/8/9, ORD-3,
RECON-3/4/5).

Rows of the outbound files are one all-string DataFrame with ``file_path``
and ``row_no``.  Identifier matching is an equi-join on ``canon_id`` of every
identity pair (EXP-4 is an equivalence relation), replacing the reference's
row-by-candidate loop.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.exprs import canon_id, casefold, normalise_prefix, text_norm
from sluice.operators.artifacts import under_prefix_join
from sluice.sources.delimited import read_delimited


# ── SRC-5 / PRJ-2: reading delimited files with per-file headers ─────────
def read_outbound_files(spark: SparkSession, paths, columns: list[str], sep: str = ","):
    """Rows (as ``read_outbound``) and the checked-file table: every file with
    a header line — header-only files included — and its missing columns."""
    return read_delimited(spark, paths, columns, sep)


def read_outbound(spark: SparkSession, paths, columns: list[str], sep: str = ",", header: bool = True,
                  names: list[str] | None = None) -> DataFrame:
    """All-string rows of delimited files whose column order may differ per
    file (H2): configured ``columns`` are found in each file's own header (trim,
    case-insensitive), absent ones are null and listed in ``missing_columns``.
    ``row_no`` counts a file's records from 1.  Files of any size are read in
    splits, and no file list passes through the driver."""
    return read_delimited(spark, paths, columns, sep, None if header else list(names or []))[0]


# ── JOIN-3 / AGG-8 / AGG-9 / RECON-3 ─────────────────────────────────────
def rule_files(outbound: DataFrame, rules: DataFrame, bucket: str, root: str | None = None) -> DataFrame:
    """Each outbound row with the rules whose prefix (in ``bucket``) holds its
    file.  Only the distinct files meet the prefixes; rows then join on their
    file.  ``root`` names a folder that stands for the bucket (mounted or local files)."""
    path = F.col("file_path")
    files = outbound.select("file_path").distinct()
    if root is None:
        files = files.select("file_path", F.regexp_extract(path, r"^[a-z0-9]+://([^/]+)/", 1).alias("bucket"),
                             F.regexp_replace(path, r"^[a-z0-9]+://[^/]+/", "").alias("key"))
    else:
        plain, top = F.regexp_replace(path, "^file:/+", "/"), root.rstrip("/") + "/"
        files = files.where(plain.startswith(top)).select("file_path", F.lit(bucket).alias("bucket"), F.substring(plain, len(top) + 1, 1 << 20).alias("key"))
    r = rules.select("rule_key", F.lit(bucket).alias("target_bucket"),
                     normalise_prefix(F.col("outbound_prefix")).alias("prefix"))
    return outbound.join(under_prefix_join(files, r).select("file_path", "rule_key"), "file_path")


def _keyed(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return df.select("*", *[canon_id(text_norm(F.col(c), df.schema[c].dataType)).alias(f"{prefix}{i}")
                            for i, c in enumerate(cols)])


def relevant_rows(candidates: DataFrame, outbound: DataFrame, rule_list) -> DataFrame:
    """The outbound rows that carry some candidate's identity: all that the
    record checks need.  One pass over the rows; only these few go on."""
    out = None
    for imap in dict.fromkeys(r.outbound_identity_map for r in rule_list):
        keys = [r.key for r in rule_list if r.outbound_identity_map == imap]
        cand_cols, out_cols = [a for a, _ in imap], [b for _, b in imap]
        k = [f"_k{i}" for i in range(len(imap))]
        wanted = _keyed(candidates.where(F.col("rule_key").isin(keys)).select(*cand_cols), cand_cols, "_k").select(*k).distinct()
        part = _keyed(outbound, out_cols, "_k").join(wanted, k, "left_semi").select(*outbound.columns)
        out = part if out is None else out.unionByName(part).dropDuplicates(["file_path", "row_no"])
    return out


def match_outbound(candidates: DataFrame, outbound: DataFrame, rule_list, rules: DataFrame, bucket: str,
                   value_mode: str = "any", files: DataFrame | None = None, own: DataFrame | None = None) -> DataFrame:
    """RECON-3 per candidate: files checked and matched, identity headers,
    expected value (``any``: some matched row per matched file; ``all``: every
    matched row).  Rules with different identity maps are planned separately
    and unioned (their number is the registry's).  ``files`` (file_path,
    missing_columns), e.g. from ``read_outbound_files``, makes header-only
    files count as checked; without it the checked files are those with rows.

    ``own`` (rule_key, file_set, file_path) limits each candidate to the files
    of its own set: ``candidates`` then carry ``file_set`` (a run, or a search
    that found a file), and the result has a row per candidate and set."""
    if value_mode not in ("any", "all"):
        raise ValueError("value_mode must be 'any' or 'all'")
    own_key = ["file_set"] if own is not None else []
    if own is not None:
        sets = own.select("rule_key", "file_set", "file_path").distinct()
        in_sets = lambda df: df.join(sets, "file_path")
    else:
        in_sets = lambda df: rule_files(df, rules, bucket)
    per_rule_rows = in_sets(outbound)
    per_rule_files = in_sets(files if files is not None else outbound.select("file_path", "missing_columns").distinct())
    by_map: dict[tuple, list] = defaultdict(list)
    for r in rule_list:
        by_map[(r.outbound_identity_map, r.outbound_column, r.outbound_expected_value)].append(r)
    results = []
    for (imap, vcol, expected), rs in by_map.items():
        keys = [r.key for r in rs]
        cand_cols = [a for a, _ in imap]
        out_cols = [b for _, b in imap]
        c = _keyed(candidates.where(F.col("rule_key").isin(keys)).select("rule_key", *own_key, *cand_cols).distinct(),
                   cand_cols, "_k")
        o = per_rule_rows.where(F.col("rule_key").isin(keys))
        id_missing = F.exists("missing_columns", lambda m: m.isin(out_cols))
        checked = per_rule_files.where(F.col("rule_key").isin(keys))
        files_agg = checked.groupBy("rule_key", *own_key).agg(
            F.count_distinct("file_path").alias("files_checked"),
            F.count_distinct(F.when(id_missing, F.col("file_path"))).alias("_files_missing"))
        o = o.where(~id_missing)
        o = _keyed(o, out_cols, "_k")
        jk = ["rule_key", *own_key] + [f"_k{i}" for i in range(len(imap))]
        val = (F.col(vcol) if vcol else F.lit(None)).cast("string")
        val_missing = F.array_contains("missing_columns", vcol) if vcol else F.lit(False)
        good = casefold(val) == casefold(F.lit(expected or ""))
        m = o.select(*jk, "file_path", "row_no", val.alias("_val"), val_missing.alias("_vmiss"), good.alias("_good"))
        # one left join from the candidates: unmatched candidates keep a row
        # with a null file, so the candidate side is planned once
        ident = [x for x in cand_cols]
        per_file = (c.join(m, jk, "left").groupBy(*jk, *ident, "file_path").agg(
            F.count("row_no").alias("_rows"),
            F.bool_or("_good").alias("_any"), F.bool_and("_good").alias("_all"), F.bool_or("_vmiss").alias("_vmiss")))
        per_cand = per_file.groupBy(*jk, *ident).agg(
            F.count("file_path").alias("files_matched"), F.sum("_rows").alias("matched_rows"),
            F.bool_and("_any").alias("value_any"), F.bool_and("_all").alias("value_all"),
            F.bool_or("_vmiss").alias("value_column_missing"))
        res = per_cand.select(
            "rule_key", *own_key, *[F.col(x).cast("string").alias(x) for x in cand_cols],
            F.coalesce("files_matched", F.lit(0)).cast("long").alias("files_matched"),
            F.coalesce("matched_rows", F.lit(0)).cast("long").alias("matched_rows"),
            (F.col("value_any") if vcol else F.lit(None).cast("boolean")).alias("value_any"),
            (F.col("value_all") if vcol else F.lit(None).cast("boolean")).alias("value_all"),
            F.coalesce("value_column_missing", F.lit(False)).alias("value_column_missing"),
            F.lit(bool(vcol)).alias("_has_value"))
        results.append(res.join(files_agg, ["rule_key", *own_key], "left"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    checked = F.coalesce("files_checked", F.lit(0))
    value_ok = F.col("value_any") if value_mode == "any" else F.col("value_all")
    reason = (F.when(checked == 0, F.lit("no outbound files were checked"))
              .when(F.coalesce("_files_missing", F.lit(0)) > 0, F.lit("identity column missing from a checked file"))
              .when(F.col("files_matched") == 0, F.lit("record not found in any outbound file"))
              .when(F.col("_has_value") & F.col("value_column_missing"), F.lit("value column missing from a matched file"))
              .when(F.col("_has_value") & ~F.coalesce(value_ok, F.lit(False)), F.lit("unexpected value in a matched file")))
    return out.select("*", checked.cast("long").alias("n_files_checked"),
                      F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("verdict"),
                      reason.alias("reason")).drop("files_checked", "_files_missing", "_has_value")


def first_matching_rows(candidates: DataFrame, outbound: DataFrame, rule_list, rules: DataFrame,
                        bucket: str, n: int = 3) -> DataFrame:
    """ORD-3: the first ``n`` matching rows per (candidate, file) of every rule,
    by row order; the window group limit keeps n rows per key before shuffling.
    Rules are planned together by identity map and value column."""
    by_map: dict[tuple, list] = defaultdict(list)
    for r in rule_list:
        by_map[(r.outbound_identity_map, r.outbound_column)].append(r.key)
    found = rule_files(outbound, rules, bucket)
    out = None
    for (imap, value), keys in by_map.items():
        cand_cols, out_cols = [a for a, _ in imap], [b for _, b in imap]
        mine = F.col("rule_key").isin(keys)
        c = _keyed(candidates.where(mine).select("rule_key", *cand_cols).distinct(), cand_cols, "_k")
        o = _keyed(found.where(mine), out_cols, "_k")
        jk = ["rule_key"] + [f"_k{i}" for i in range(len(imap))]
        w = Window.partitionBy(*jk, "file_path").orderBy("row_no")
        keep = [*out_cols, *([value] if value else [])]
        part = (c.select(*jk).distinct().join(o, jk).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .select("rule_key", *[F.col(f"_k{i}").alias(f"key_{cand_cols[i]}") for i in range(len(imap))],
                        "file_path", "rank", "row_no", *dict.fromkeys(keep)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def reconcile_rows(outbound: DataFrame, report: DataFrame, enforce: bool = True) -> DataFrame:
    """RECON-4 per run: file rows vs records the log reported; skipped when
    the log reported none."""
    rows = outbound.groupBy("run_id").agg(F.count(F.lit(1)).alias("file_rows"))
    j = rows.join(report.select("run_id", F.col("records_to_s3").alias("reported_rows")), "run_id", "full")
    fr, rr = F.coalesce("file_rows", F.lit(0)), F.col("reported_rows")
    verdict = (F.when(rr.isNull(), "SKIPPED").when(fr == rr, "PASS")
               .otherwise(F.lit("FAIL" if enforce else "WARN")))
    return j.select("run_id", fr.cast("long").alias("file_rows"), rr.alias("reported_rows"), verdict.alias("verdict"))


def id_overlap(source_ids: DataFrame, output_ids: DataFrame, min_overlap_tenths: int = 1000,
               max_diff_tenths: int = 0) -> DataFrame:
    """RECON-5: distinct canonical ids of source vs output.

    overlap = common / source, diff = |output - source| / source, both in
    tenths of a percent (rounded half up, integer arithmetic).  PASS iff the
    source is non-empty, overlap >= ``min_overlap_tenths`` and diff <=
    ``max_diff_tenths``.
    """
    s = source_ids.select(canon_id(text_norm(F.col("id"))).alias("id")).distinct().withColumn("_s", F.lit(1))
    o = output_ids.select(canon_id(text_norm(F.col("id"))).alias("id")).distinct().withColumn("_o", F.lit(1))
    j = s.join(o, "id", "full")
    agg = j.agg(F.count("_s").alias("n_source"), F.count("_o").alias("n_output"),
                F.count_if(F.col("_s").isNotNull() & F.col("_o").isNotNull()).alias("n_common"))
    ns, no, nc = F.col("n_source"), F.col("n_output"), F.col("n_common")
    ov = F.when(ns > 0, F.floor((nc * 2000 + ns) / (ns * 2))).cast("long")
    df = F.when(ns > 0, F.floor((F.abs(no - ns) * 2000 + ns) / (ns * 2))).cast("long")
    out = agg.select("n_source", "n_output", "n_common", ov.alias("overlap_tenths"), df.alias("diff_tenths"))
    text = lambda t: F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string"), F.lit("%"))
    status = F.when((ns > 0) & (F.col("overlap_tenths") >= min_overlap_tenths)
                    & (F.col("diff_tenths") <= max_diff_tenths), "PASS").otherwise("FAIL")
    return out.select("*", text(F.col("overlap_tenths")).alias("overlap_pct_text"),
                      text(F.col("diff_tenths")).alias("diff_pct_text"), status.alias("status"))
