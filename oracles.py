"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not from the Spark code: the grid is a cross product of entities
and steps left-joined with last-write-wins cells, fills are window ``last_value IGNORE NULLS``, and so
on. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
STATIC = ("acctbal", "building", "nation")
FEATURES = STATIC + EVENT_TYPES
RANGES = {"click": (2, 200), "error": (2, 200), "purchase": (2, 200), "signup": (2, 200), "view": (2, 200),
          "acctbal": (0, None)}
LOG_COLS = ("purchase", "view")
STATS = ("first", "last", "mean", "min", "max", "std", "delta", "slope")


def r6(x: str) -> str:
    return f"round({x}, 6)"


def clean_num(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL OR isnan({x}) OR isinf({x}) THEN 0.0 ELSE ({x}) END)"


def cond_range(c: str) -> str:
    lo, hi = RANGES.get(c, (None, None))
    parts = []
    if lo is not None:
        parts.append(f"{c} >= {float(lo)}")
    if hi is not None:
        parts.append(f"{c} <= {float(hi)}")
    return f"CASE WHEN {' AND '.join(parts)} THEN {c} END" if parts else c


def binary01(x: str) -> str:
    return f"least(greatest(round_even({x}, 0), 0.0), 1.0)"


def split_expr(idc: str) -> str:
    return f"(CASE WHEN {idc} % 4 <= 1 THEN 'a' WHEN {idc} % 4 = 2 THEN 'b' ELSE 'c' END)"


def ctes_grid() -> list[str]:
    cells = ",\n      ".join(f"arg_max(value, ord) FILTER (WHERE parameter = '{p}') AS {p}" for p in EVENT_TYPES)
    ev_list = ", ".join(f"'{p}'" for p in EVENT_TYPES)
    return [
        """ev_log AS (
    SELECT user_id AS id, date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) AS elapsed,
           event_type AS parameter, CASE WHEN value < 1 THEN -1.0 ELSE value END AS value, event_id AS ord
    FROM events)""",
        f"""ev_binned AS (
    SELECT id, CAST(ceil(elapsed / 86400000000.0) AS BIGINT) AS day, parameter, value, ord
    FROM ev_log
    WHERE parameter IN ({ev_list}) AND elapsed >= 0 AND value IS NOT NULL AND value <> -1.0)""",
        f"""ev_cells AS (
    SELECT id, day,
      {cells}
    FROM ev_binned WHERE day <= 30 GROUP BY id, day)""",
        """ev_static AS (
    SELECT c_custkey AS id, c_acctbal AS acctbal,
           CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS building,
           CAST(c_nationkey AS DOUBLE) AS nation
    FROM customer)""",
        """ev_labels AS (
    SELECT user_id AS id,
           CAST(coalesce(sum(value) FILTER (WHERE event_type = 'error'), 0.0) > 640.0 AS INTEGER) AS label
    FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
    GROUP BY user_id)""",
        f"""ev_grid AS (
    SELECT e.id AS user_id, CAST(d.day AS BIGINT) AS day, s.acctbal, s.building, s.nation,
           {", ".join("c." + p for p in EVENT_TYPES)}, l.label, {split_expr("e.id")} AS split
    FROM (SELECT DISTINCT id FROM ev_log) e
    CROSS JOIN generate_series(0, 30) AS d(day)
    LEFT JOIN ev_static s ON s.id = e.id
    LEFT JOIN ev_labels l ON l.id = e.id
    LEFT JOIN ev_cells c ON c.id = e.id AND c.day = d.day)""",
        f"""ev_clean AS (
    SELECT user_id, day, {", ".join(cond_range(c) + " AS " + c for c in FEATURES)}, label, split
    FROM ev_grid)""",
    ]


def ctes_ffill() -> list[str]:
    fills = [
        "coalesce((SELECT building FROM ev_clean WHERE split = 'a' AND building IS NOT NULL "
        "GROUP BY building ORDER BY count(*) DESC, building ASC LIMIT 1), 0.0) AS building"]
    fills += [f"coalesce(quantile_cont({c}, 0.5) FILTER (WHERE split = 'a'), 0.0) AS {c}"
              for c in FEATURES if c != "building"]
    w = "OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cols = []
    for c in FEATURES:
        e = f"coalesce(last_value({c} IGNORE NULLS) {w}, (SELECT {c} FROM ev_fill))"
        cols.append(f"{binary01(e) if c == 'building' else e} AS {c}")
    return ctes_grid() + [
        f"ev_fill AS (SELECT {', '.join(fills)} FROM ev_clean)",
        f"ev_ffill AS (SELECT user_id, day, {', '.join(cols)}, label, split FROM ev_clean)",
    ]


def ctes_linear() -> list[str]:
    logged = []
    for c in FEATURES:
        if c == "building":
            logged.append(f"{binary01(c)} AS {c}")
        elif c in LOG_COLS:
            logged.append(f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END AS {c}")
        else:
            logged.append(c)
    scaled = [c for c in FEATURES if c != "building"]
    par = []
    for c in scaled:
        par.append(f"quantile_cont({c}, 0.5) FILTER (WHERE split = 'a') AS {c}__med")
        par.append(f"quantile_cont({c}, 0.75) FILTER (WHERE split = 'a') - "
                   f"quantile_cont({c}, 0.25) FILTER (WHERE split = 'a') AS {c}__iqr0")
    lin = []
    for c in FEATURES:
        if c == "building":
            lin.append(c)
        else:
            iqr = f"(CASE WHEN p.{c}__iqr0 IS NULL OR p.{c}__iqr0 = 0 THEN 1.0 ELSE p.{c}__iqr0 END)"
            lin.append(f"(g.{c} - p.{c}__med) / {iqr} AS {c}")
    return ctes_ffill() + [
        f"ev_logged AS (SELECT user_id, day, {', '.join(logged)}, label, split FROM ev_ffill)",
        f"ev_par AS (SELECT {', '.join(par)} FROM ev_logged)",
        f"ev_linear AS (SELECT g.user_id, g.day, {', '.join(lin)}, g.label, g.split "
        f"FROM ev_logged g CROSS JOIN ev_par p)",
    ]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def feat_stats_sql(src: str) -> str:
    cols = [f"arg_min({c}, day) AS {c}" for c in STATIC]
    for c in EVENT_TYPES:
        first, last = f"arg_min({c}, day)", f"arg_max({c}, day)"
        slope = f"regr_slope({c}, CAST(day AS DOUBLE))"
        exprs = {
            "first": first, "last": last, "mean": f"avg({c})", "min": f"min({c})", "max": f"max({c})",
            "std": f"stddev_pop({c})", "delta": f"({last} - {first})",
            "slope": f"coalesce(CASE WHEN isnan({slope}) THEN NULL ELSE {slope} END, 0.0)",
        }
        cols += [f"{exprs[s]} AS {c}_{s}" for s in STATS]
    return f"SELECT user_id, {', '.join(cols)}, arg_min(label, day) AS label FROM {src} GROUP BY user_id"


def feature_names() -> list[str]:
    return list(STATIC) + [f"{c}_{s}" for c in EVENT_TYPES for s in STATS]


def sql_engineered() -> str:
    names = feature_names()
    outer = ", ".join(f"{r6(clean_num(n))} AS {n}" for n in names)
    return with_(ctes_ffill() + [f"feat AS ({feat_stats_sql('ev_ffill')})"],
                 f"SELECT user_id, {outer}, label, {split_expr('user_id')} AS split FROM feat")


def sql_grid() -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(ctes_grid(), f"SELECT user_id, day, {cols}, label, split FROM ev_grid")


def sql_clean() -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(ctes_grid(), f"SELECT user_id, day, {cols}, label, split FROM ev_clean")


def sql_ffill() -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(ctes_ffill(), f"SELECT user_id, day, {cols}, label, split FROM ev_ffill")


def sql_fill_defaults() -> str:
    parts = [f"SELECT '{c}' AS \"column\", {r6(c)} AS fill_value FROM ev_fill" for c in FEATURES]
    return with_(ctes_ffill(), "\nUNION ALL\n".join(parts))


def sql_linear() -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(ctes_linear(), f"SELECT user_id, day, {cols}, label, split FROM ev_linear")


def sql_scaler_params() -> str:
    parts = [f"SELECT '{c}' AS \"column\", {r6(c + '__med')} AS median, "
             f"{r6(f'CASE WHEN {c}__iqr0 IS NULL OR {c}__iqr0 = 0 THEN 1.0 ELSE {c}__iqr0 END')} AS iqr "
             f"FROM ev_par" for c in FEATURES if c != "building"]
    return with_(ctes_linear(), "\nUNION ALL\n".join(parts))


def sql_last_state() -> str:
    cols = ", ".join(f"{r6(f'arg_max({c}, CASE WHEN {c} IS NOT NULL THEN day END)')} AS {c}" for c in FEATURES)
    return with_(ctes_grid(), f"SELECT user_id, {cols}, arg_min(label, day) AS label FROM ev_clean GROUP BY user_id")


def sql_grid_summary() -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in FEATURES)
    return with_(ctes_grid(), f"""SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_entities,
        CAST(count(*) AS BIGINT) AS n_rows, CAST(sum({nulls}) AS BIGINT) AS missing_cells,
        CAST(count(DISTINCT CASE WHEN label IS NOT NULL THEN user_id END) AS BIGINT) AS n_labelled,
        {r6(f"CAST(sum({nulls}) AS DOUBLE) / (count(*) * {len(FEATURES)})")} AS missing_rate
        FROM ev_grid""")


# ------------------------------------------------------------------ tokens
def lst6(x: str) -> str:
    return f"list_transform({x}, lambda v: round(v, 6))"


def lst6_2(x: str) -> str:
    return f"list_transform({x}, lambda r: list_transform(r, lambda v: round(v, 6)))"


def ctes_tokens() -> list[str]:
    par = []
    for c in FEATURES:
        if c == "building":
            continue
        x = f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END" if c in LOG_COLS else c
        par.append(f"coalesce(quantile_cont({x}, 0.5) FILTER (WHERE split = 'a'), 0.0) AS {c}__med")
        par.append(f"quantile_cont({x}, 0.75) FILTER (WHERE split = 'a') - "
                   f"quantile_cont({x}, 0.25) FILTER (WHERE split = 'a') AS {c}__iqr0")
    parts = []
    for i, c in enumerate(FEATURES):
        if c == "building":
            v = binary01(c)
        else:
            x = f"ln(1 + greatest({c}, 0.0))" if c in LOG_COLS else c
            iqr = f"(CASE WHEN p.{c}__iqr0 IS NULL OR p.{c}__iqr0 = 0 THEN 1.0 ELSE p.{c}__iqr0 END)"
            v = f"({x} - p.{c}__med) / {iqr}"
        cond = f"{c} IS NOT NULL" + (" AND day = 0" if c in STATIC else "")
        parts.append(f"SELECT user_id, CAST(day AS DOUBLE) / 30.0 AS t_scaled, {v} AS value_scaled, label, "
                     f"{i} AS var_idx, split FROM ev_clean CROSS JOIN ev_tpar p WHERE {cond}")
    return ctes_grid() + [f"ev_tpar AS (SELECT {', '.join(par)} FROM ev_clean)",
                          "ev_tokens AS (" + "\nUNION ALL\n".join(parts) + ")"]


def sql_token_params() -> str:
    parts = ["SELECT 'building' AS \"column\", true AS is_binary, false AS use_log1p, 0.0 AS median, 1.0 AS iqr"]
    for c in FEATURES:
        if c == "building":
            continue
        iqr = f"CASE WHEN {c}__iqr0 IS NULL OR {c}__iqr0 = 0 THEN 1.0 ELSE {c}__iqr0 END"
        parts.append(f"SELECT '{c}', false, {'true' if c in LOG_COLS else 'false'}, {r6(c + '__med')}, {r6(iqr)} FROM ev_tpar")
    return with_(ctes_tokens(), "\nUNION ALL\n".join(parts))


def sql_tokens() -> str:
    ohe = ", ".join(f"CAST(var_idx = {i} AS INTEGER) AS var_{c}" for i, c in enumerate(FEATURES))
    return with_(ctes_tokens(), f"SELECT user_id, {r6('t_scaled')} AS t_scaled, {r6('value_scaled')} AS value_scaled, "
                                f"label, var_idx, split, {ohe} FROM ev_tokens")


def sql_token_counts() -> str:
    return with_(ctes_tokens(), "SELECT user_id, CAST(count(*) AS BIGINT) AS n_tokens FROM ev_tokens GROUP BY user_id")


def sql_token_summary() -> str:
    return with_(ctes_tokens(), f"""SELECT split, CAST(count(*) AS BIGINT) AS n_tokens,
        CAST(count(DISTINCT user_id) AS BIGINT) AS n_entities,
        {r6('count(*) / count(DISTINCT user_id)')} AS avg_tokens,
        {r6('min(t_scaled)')} AS min_t, {r6('max(t_scaled)')} AS max_t FROM ev_tokens GROUP BY split""")


# ------------------------------------------------------------------ sequences (Q1–Q12)
def sql_fixed_sequences() -> str:
    row = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURES) + "]"
    return with_(ctes_linear(), f"""SELECT user_id, {lst6_2(f'list({row} ORDER BY day)')} AS seq,
        arg_min(label, day) AS label, CAST(count(*) AS INTEGER) AS length FROM ev_linear GROUP BY user_id""")


def token_vec() -> str:
    onehot = ", ".join(f"CAST(var_idx = {i} AS DOUBLE)" for i in range(len(FEATURES)))
    return f"[t_scaled, value_scaled, {onehot}]"


def sql_token_sequences() -> str:
    return with_(ctes_tokens(), f"""SELECT user_id, {lst6_2(f'list({token_vec()} ORDER BY t_scaled, var_idx)')} AS seq,
        first(label) AS label, CAST(count(*) AS INTEGER) AS length FROM ev_tokens GROUP BY user_id""")


def sql_mask_delta() -> str:
    w = "OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    masks = [f"CAST({c} IS NOT NULL AS INTEGER) AS mask_{c}" for c in FEATURES]
    deltas = [f"CAST(coalesce(day - last_value(CASE WHEN {c} IS NOT NULL THEN day END IGNORE NULLS) {w}, day + 1) "
              f"AS DOUBLE) AS delta_{c}" for c in FEATURES]
    return with_(ctes_grid(), f"SELECT user_id, day, label, split, {', '.join(masks + deltas)} FROM ev_clean")


def sql_pool() -> str:
    cols = []
    for c in FEATURES:
        w = "exp(2.0 * CAST(day AS DOUBLE) / 30.0)"
        cols += [f"{r6(f'arg_max({c}, day)')} AS {c}_last", f"{r6(f'avg({c})')} AS {c}_mean",
                 f"{r6(f'max({c})')} AS {c}_max",
                 f"{r6(f'sum({w} * {c}) / sum(CASE WHEN {c} IS NOT NULL THEN {w} END)')} AS {c}_recency"]
    return with_(ctes_linear(), f"SELECT user_id, {', '.join(cols)} FROM ev_linear GROUP BY user_id")


def sql_static_row() -> str:
    cols = ", ".join(f"{r6(f'arg_min({c}, day)')} AS {c}" for c in STATIC)
    return with_(ctes_ffill(), f"SELECT user_id, {cols} FROM ev_ffill GROUP BY user_id")


def sql_variable_series() -> str:
    parts = [f"SELECT user_id, '{c}' AS variable, {lst6(f'list(CAST({c} AS DOUBLE) ORDER BY day)')} AS series "
             f"FROM ev_ffill GROUP BY user_id" for c in EVENT_TYPES]
    return with_(ctes_ffill(), "\nUNION ALL\n".join(parts))


def sql_length_stats() -> str:
    return with_(ctes_tokens(), f"""SELECT split, {r6('avg(n)')} AS avg_length, CAST(max(n) AS INTEGER) AS max_length,
        CAST(count(*) AS BIGINT) AS n_sequences
        FROM (SELECT user_id, split, count(*) AS n FROM ev_tokens GROUP BY user_id, split) GROUP BY split""")


def sql_pad_batches(batch: int = 16) -> str:
    zero = "[" + ", ".join(["0.0"] * (len(FEATURES) + 2)) + "]"
    return with_(ctes_tokens() + [
        f"seqs AS (SELECT user_id, list({token_vec()} ORDER BY t_scaled, var_idx) AS seq, first(label) AS label, "
        f"count(*) AS n FROM ev_tokens GROUP BY user_id)",
        f"idx AS (SELECT *, row_number() OVER (ORDER BY user_id) - 1 AS pos FROM seqs)",
        f"b AS (SELECT *, CAST(floor(pos / {batch}) AS BIGINT) AS batch_id FROM idx)",
        "m AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS max_len FROM b)"],
        f"""SELECT user_id, batch_id, CAST(pos AS BIGINT) AS pos, CAST(n AS INTEGER) AS length,
        CAST(max_len AS INTEGER) AS max_len,
        {lst6_2(f'list_concat(seq, list_transform(range(max_len - n), lambda i: {zero}))')} AS padded,
        list_concat(list_transform(range(n), lambda i: false), list_transform(range(max_len - n), lambda i: true)) AS pad_mask,
        label FROM m""")


# ------------------------------------------------------------------ metrics
CONFIGS = (
    (0, "n_chars", "CAST(n_chars AS DOUBLE)"),
    (1, "neg_n_chars", "-CAST(n_chars AS DOUBLE)"),
    (2, "n_lines", "CAST(len(string_split(text, chr(10))) AS DOUBLE)"),
    (3, "n_digits", "CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE)"),
)


def doc_split(c: str = "doc_id") -> str:
    return split_expr(c)


def rank_metrics_sql(src: str, groups: list[str], prefix: str = "") -> str:
    """AUROC from average ranks (Mann–Whitney U); AP as Σ pos(s)/P · precision(s) over distinct thresholds."""
    g = ", ".join(groups)
    gsel = (g + ", ") if groups else ""
    part = f"PARTITION BY {g}" if groups else ""
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in groups) or "TRUE"
    return f"""(WITH s AS (SELECT {gsel}score, label FROM {src} WHERE score IS NOT NULL AND label IS NOT NULL),
    rk AS (SELECT {gsel}label, rank() OVER ({part} ORDER BY score)
                  + (count(*) OVER ({part + ', ' if groups else 'PARTITION BY '}score) - 1) / 2.0 AS r FROM s),
    au AS (SELECT {gsel}CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
                  CAST(sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
                  sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rsum FROM rk {'GROUP BY ' + g if groups else ''}),
    c AS (SELECT {gsel}score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, count(*) AS n FROM s
          GROUP BY {gsel}score),
    cu AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(n) OVER ({part} ORDER BY score DESC) AS k FROM c),
    ap AS (SELECT {gsel}sum(CASE WHEN pos > 0 THEN pos * tp / k END) AS ap_num FROM cu {'GROUP BY ' + g if groups else ''})
    SELECT {', '.join('a.' + c for c in groups) + ', ' if groups else ''}a.n_pos AS {prefix}n_pos, a.n_neg AS {prefix}n_neg,
           CASE WHEN a.n_pos > 0 AND a.n_neg > 0 THEN (a.rsum - a.n_pos * (a.n_pos + 1) / 2.0) / (a.n_pos * a.n_neg) END
             AS {prefix}auroc,
           CASE WHEN a.n_pos > 0 THEN b.ap_num / a.n_pos END AS {prefix}auprc
    FROM au a JOIN ap b ON {on})"""


def scored_docs_sql(target: str = "quality") -> str:
    parts = [f"SELECT d.doc_id, {doc_split('d.doc_id')} AS split, l.{target} AS label, {i} AS cfg_idx, "
             f"'{n}' AS config_name, {e} AS score FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
             for i, n, e in CONFIGS]
    return "(" + " UNION ALL ".join(parts) + ")"


def board_sql(target: str = "quality") -> str:
    m = rank_metrics_sql(f"(SELECT * FROM {scored_docs_sql(target)} WHERE split IN ('b', 'c'))",
                         ["cfg_idx", "config_name", "split"])
    return f"""(SELECT cfg_idx, config_name,
        max(CASE WHEN split = 'b' THEN auroc END) AS val_auroc, max(CASE WHEN split = 'b' THEN auprc END) AS val_auprc,
        max(CASE WHEN split = 'c' THEN auroc END) AS test_auroc, max(CASE WHEN split = 'c' THEN auprc END) AS test_auprc
        FROM {m} GROUP BY cfg_idx, config_name)"""


def sql_ranking_metrics() -> str:
    src = "(SELECT d.lang, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label FROM documents d JOIN labels l USING (doc_id))"
    return f"SELECT lang, n_pos, n_neg, {r6('auroc')} AS auroc, {r6('auprc')} AS auprc FROM {rank_metrics_sql(src, ['lang'])}"


def conf_sql(src: str, groups: list[str]) -> str:
    g = ", ".join(groups)
    gsel = (g + ", ") if groups else ""
    return f"""(SELECT {gsel}CAST(sum(CASE WHEN pred = 1 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN pred = 1 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(sum(CASE WHEN pred = 0 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
        CAST(sum(CASE WHEN pred = 0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
        CAST(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pred_pos,
        CAST(sum(CASE WHEN pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_pred_neg, CAST(count(*) AS BIGINT) AS n
        FROM {src} {'GROUP BY ' + g if groups else ''})"""


def ratio_sql(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({a} + {b}, 0), 0.0)"


def sql_binary_metrics() -> str:
    src = "(SELECT d.lang, CAST(d.n_chars > 1500 AS INTEGER) AS pred, l.quality AS label FROM documents d JOIN labels l USING (doc_id))"
    rk = rank_metrics_sql(f"(SELECT lang, CAST(pred AS DOUBLE) AS score, label FROM {src})", ["lang"])
    return f"""SELECT c.*, {r6(ratio_sql('tp', 'fp'))} AS precision, {r6(ratio_sql('tp', 'fn'))} AS recall,
        {r6(ratio_sql('tn', 'fp'))} AS specificity, {r6('r.auroc')} AS auroc, {r6('r.auprc')} AS auprc
        FROM {conf_sql(src, ['lang'])} c LEFT JOIN {rk} r ON c.lang = r.lang"""


def sql_scale_metrics() -> str:
    base = ("(SELECT least(10, 1 + CAST(floor(d.n_chars / 1000) AS INTEGER)) AS score, l.quality AS label "
            "FROM documents d JOIN labels l USING (doc_id))")
    hard = f"(SELECT CAST(score >= 6 AS INTEGER) AS pred, label FROM {base})"
    rk = rank_metrics_sql(f"(SELECT CAST(pred AS DOUBLE) AS score, label FROM {hard})", [])
    rr = rank_metrics_sql(f"(SELECT (score - 1.0) / 9.0 AS score, label FROM {base})", [], "risk_")
    return f"""SELECT c.*, {r6(ratio_sql('tp', 'fp'))} AS precision, {r6(ratio_sql('tp', 'fn'))} AS recall,
        {r6(ratio_sql('tn', 'fp'))} AS specificity, {r6('r.auroc')} AS auroc, {r6('r.auprc')} AS auprc,
        {r6('q.risk_auroc')} AS risk_auroc, {r6('q.risk_auprc')} AS risk_auprc
        FROM {conf_sql(hard, [])} c, {rk} r, {rr} q"""


def sql_leaderboard() -> str:
    cols = ", ".join(f"{r6(c)} AS {c}" for c in ("val_auroc", "val_auprc", "test_auroc", "test_auprc"))
    return f"SELECT cfg_idx, config_name, {cols} FROM {board_sql()}"


def sql_select_best() -> str:
    cols = ", ".join(f"{r6(c)} AS {c}" for c in ("val_auroc", "val_auprc", "test_auroc", "test_auprc"))
    return f"""SELECT cfg_idx, config_name, {cols} FROM {board_sql()}
        ORDER BY val_auprc DESC NULLS LAST, val_auroc DESC NULLS LAST, cfg_idx LIMIT 1"""


def sql_compare() -> str:
    return f"""SELECT a.config_name, {r6('a.test_auroc')} AS a_auroc, {r6('a.test_auprc')} AS a_auprc,
        {r6('b.test_auroc')} AS b_auroc, {r6('b.test_auprc')} AS b_auprc,
        {r6('b.test_auroc - a.test_auroc')} AS delta_auroc, {r6('b.test_auprc - a.test_auprc')} AS delta_auprc
        FROM {board_sql('quality')} a JOIN {board_sql('toxic')} b ON a.config_name = b.config_name"""


def history_sql() -> str:
    src = "(SELECT day, error AS score, label FROM ev_ffill WHERE split = 'b')"
    return f"(SELECT day + 1 AS epoch, auroc, auprc FROM {rank_metrics_sql(src, ['day'])})"


def sql_history() -> str:
    return with_(ctes_ffill(), f"SELECT epoch, {r6('auroc')} AS auroc, {r6('auprc')} AS auprc FROM {history_sql()}")


def sql_early_stopping(patience: int = 3) -> str:
    return with_(ctes_ffill() + [
        f"h AS {history_sql()}",
        """i AS (SELECT *, (max((auprc, auroc)) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                 AS prev FROM h)""",
        "j AS (SELECT *, prev IS NULL OR (auprc, auroc) > prev AS improved FROM i)",
        "k AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch) AS since FROM j)",
        f"st AS (SELECT coalesce(min(CASE WHEN since >= {patience} THEN epoch END), max(epoch)) AS stop_epoch FROM k)"],
        f"""SELECT st.stop_epoch, max(k.epoch) AS best_epoch, {r6('arg_max(k.auprc, k.epoch)')} AS best_auprc,
            {r6('arg_max(k.auroc, k.epoch)')} AS best_auroc
            FROM k, st WHERE k.improved AND k.epoch <= st.stop_epoch GROUP BY st.stop_epoch""")


def sql_split_counts() -> str:
    return with_(ctes_grid(), """SELECT split, CAST(count(*) AS BIGINT) AS n_total, CAST(count(label) AS BIGINT) AS n_labelled
        FROM (SELECT DISTINCT user_id, split, label FROM ev_grid) GROUP BY split""")


# ------------------------------------------------------------------ profile (E1–E9) on train rows of the clean grid
def sql_column_profile() -> str:
    parts = []
    types = {c: "double" for c in FEATURES}
    types.update({"user_id": "bigint", "day": "bigint", "label": "int"})
    cols = ["user_id", "day", *FEATURES, "label"]
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", '{types[c]}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null,
            CAST(count(*) - count({c}) AS BIGINT) AS missing, {r6(f'(count(*) - count({c})) * 100.0 / count(*)')} AS missing_pct,
            CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique, {r6(f'min({c})')} AS min,
            {r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS median,
            {r6(f'quantile_cont({c}, 0.75)')} AS q75, {r6(f'max({c})')} AS max, {r6(f'avg({c})')} AS mean,
            {r6(f'stddev_samp({c})')} AS std FROM tr""")
    return with_(ctes_grid() + ["tr AS (SELECT user_id, day, " + ", ".join(FEATURES) + ", label FROM ev_clean WHERE split = 'a')"],
                 "\nUNION ALL\n".join(parts))


def _train() -> list[str]:
    return ctes_grid() + ["tr AS (SELECT * FROM ev_clean WHERE split = 'a')"]


def sql_value_counts() -> str:
    return with_(_train(), f"SELECT {r6('building')} AS value, CAST(count(*) AS BIGINT) AS count FROM tr GROUP BY building")


def histogram_sql(expr: str, where: str, bins: int = 40) -> str:
    return f"""v AS (SELECT {expr} AS x FROM tr WHERE {where}),
    rg AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                  CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v HAVING count(*) > 0),
    cnt AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}.0), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
            FROM v, rg GROUP BY 1)"""


def sql_histogram(col: str = "view", log10: bool = False) -> str:
    expr, where = (f"log10({col})", f"{col} > 0") if log10 else (col, f"{col} IS NOT NULL")
    return with_(_train() + [histogram_sql(expr, where)],
                 f"""SELECT CAST(b.bin AS INTEGER) AS bin, {r6('lo + b.bin * (hi - lo) / 40.0')} AS bin_start,
                 {r6('lo + (b.bin + 1) * (hi - lo) / 40.0')} AS bin_end, CAST(coalesce(cnt.n, 0) AS BIGINT) AS count
                 FROM rg CROSS JOIN range(40) b(bin) LEFT JOIN cnt ON cnt.bin = b.bin""")


def sql_log_histogram() -> str:
    return sql_histogram("purchase", True)


def sql_box_stats(col: str = "click") -> str:
    return with_(_train() + [f"q AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS med, "
                             f"quantile_cont({col}, 0.75) AS q3 FROM tr)"],
                 f"""SELECT {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3,
                 {r6(f'min(CASE WHEN {col} >= q1 - 1.5 * (q3 - q1) THEN {col} END)')} AS whisker_low,
                 {r6(f'max(CASE WHEN {col} <= q3 + 1.5 * (q3 - q1) THEN {col} END)')} AS whisker_high,
                 CAST(sum(CASE WHEN {col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT)
                   AS n_outliers FROM tr, q WHERE {col} IS NOT NULL GROUP BY q1, med, q3""")


def sql_time_profile(col: str = "error") -> str:
    return with_(_train(), f"""SELECT day, {r6(f'avg({col})')} AS mean, {r6(f'quantile_cont({col}, 0.5)')} AS median,
        {r6(f'quantile_cont({col}, 0.25)')} AS q25, {r6(f'quantile_cont({col}, 0.75)')} AS q75,
        CAST(count({col}) AS BIGINT) AS n_obs FROM tr GROUP BY day""")


def draw_rank(seed: int, draw: str, c: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|{draw}|' || CAST({c} AS VARCHAR)), 1, 15) AS BIGINT)"


def sql_random_trajectories(col: str = "signup", n: int = 10, seed: int = 42) -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(_train() + [f"ids AS (SELECT DISTINCT user_id FROM tr WHERE {col} IS NOT NULL)",
                             f"pick AS (SELECT user_id FROM ids ORDER BY {draw_rank(seed, 'trajectory', 'user_id')}, user_id LIMIT {n})"],
                 f"SELECT user_id, day, {cols}, label, split FROM tr WHERE user_id IN (SELECT user_id FROM pick)")


def sql_shape() -> str:
    cols = ", ".join(["user_id", "day", *FEATURES, "label", "split"])
    return with_(_train(), f"SELECT CAST(count(*) AS BIGINT) AS n_rows, {len(FEATURES) + 4} AS n_cols, "
                           f"'{cols}' AS columns FROM tr")


# ------------------------------------------------------------------ sampling
def sql_labelled_features() -> str:
    names = feature_names()
    outer = ", ".join(f"{r6(clean_num(n))} AS {n}" for n in names)
    return with_(ctes_ffill() + [f"feat AS ({feat_stats_sql('ev_ffill')})"],
                 f"SELECT user_id, {outer}, label, {split_expr('user_id')} AS split FROM feat WHERE label IS NOT NULL")


def sql_budget_subsets(budgets=(100, 500, 1000), seed: int = 42) -> str:
    parts = ["SELECT 'full' AS budget, doc_id FROM (SELECT DISTINCT doc_id FROM documents)"]
    for b in budgets:
        parts.append(f"SELECT '{b}' AS budget, doc_id FROM (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM documents) "
                     f"ORDER BY {draw_rank(seed, f'budget-{b}', 'doc_id')}, doc_id LIMIT {b})")
    return "\nUNION ALL\n".join(parts)


def sql_stratified(n: int = 3, seed: int = 42) -> str:
    parts = []
    for k, c in enumerate((1, 0)):
        parts.append(f"SELECT * FROM (SELECT doc_id, quality, toxic, {k} AS class_order FROM labels WHERE quality = {c} "
                     f"ORDER BY {draw_rank(seed, 'class', 'doc_id')}, doc_id LIMIT {n})")
    return "\nUNION ALL\n".join(parts)


def sql_distinct_ids() -> str:
    return "SELECT DISTINCT user_id FROM events"


# ------------------------------------------------------------------ vectors
def dbl(e: str = "embedding") -> str:
    return f"CAST({e} AS DOUBLE[])"


def l2n(e: str) -> str:
    return (f"list_transform({e}, lambda x: x / greatest(sqrt(list_sum(list_transform({e}, lambda y: y * y))), 1e-12))")


def sql_l2_normalize() -> str:
    return f"SELECT vec_id, {lst6(l2n(dbl()))} AS embedding, label FROM embeddings"


def sql_extract_embeddings() -> str:
    w = "exp(2.0 * CAST(day AS DOUBLE) / 30.0)"
    rec = "[" + ", ".join(f"sum({w} * {c}) / sum({w})" for c in FEATURES) + "]"
    return with_(ctes_linear(), f"SELECT user_id, arg_min(label, day) AS label, {lst6(rec)} AS embedding "
                                f"FROM ev_linear GROUP BY user_id")


CHANNEL_WEIGHTS = {"click": 0.5, "error": 1.0, "purchase": 2.0, "signup": -1.0, "view": 0.0}


def sql_channel_mean() -> str:
    m = "(" + " + ".join(EVENT_TYPES) + f") / {float(len(EVENT_TYPES))}"
    return with_(ctes_ffill(), f"""SELECT user_id, {lst6(f'list_concat(list({m} ORDER BY day), '
                                 f'[arg_min(acctbal, day), arg_min(building, day), arg_min(nation, day)])')} AS embedding
        FROM ev_ffill GROUP BY user_id""")


def sql_channel_weighted() -> str:
    import math
    mx = max(CHANNEL_WEIGHTS.values())
    z = sum(math.exp(w - mx) for w in CHANNEL_WEIGHTS.values())
    terms = " + ".join(f"{math.exp(w - mx) / z!r} * {c}" for c, w in CHANNEL_WEIGHTS.items())
    return with_(ctes_ffill(), f"SELECT user_id, {lst6(f'list(({terms}) ORDER BY day)')} AS embedding "
                               f"FROM ev_ffill GROUP BY user_id")


def sql_silhouette() -> str:
    d2 = "list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""WITH v AS (SELECT vec_id, label, {dbl()} AS e FROM embeddings),
        pd AS (SELECT a.vec_id, a.label AS la, b.label AS lb, {d2} AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id),
        per AS (SELECT vec_id, la, lb, avg(d) AS m FROM pd GROUP BY vec_id, la, lb),
        ab AS (SELECT vec_id, max(CASE WHEN la = lb THEN m END) AS a, min(CASE WHEN la <> lb THEN m END) AS b
               FROM per GROUP BY vec_id),
        allv AS (SELECT v.vec_id, ab.a, ab.b FROM v LEFT JOIN ab ON v.vec_id = ab.vec_id)
        SELECT {r6('avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END)')}
          AS silhouette FROM allv"""


def sql_davies_bouldin() -> str:
    return f"""WITH v AS (SELECT vec_id, label, {dbl()} AS e FROM embeddings),
        x AS (SELECT label, u.i, u.x FROM v, unnest(e) WITH ORDINALITY AS u(x, i)),
        c AS (SELECT label, list(avg_x ORDER BY i) AS ce FROM (SELECT label, i, avg(x) AS avg_x FROM x GROUP BY label, i)
              GROUP BY label),
        s AS (SELECT v.label, avg(sqrt(list_sum(list_transform(list_zip(v.e, c.ce), lambda p: (p[1] - p[2]) * (p[1] - p[2])))))
              AS sc FROM v JOIN c ON v.label = c.label GROUP BY v.label),
        r AS (SELECT a.label, max((sa.sc + sb.sc) /
                 sqrt(list_sum(list_transform(list_zip(a.ce, b.ce), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))) AS m
              FROM c a JOIN c b ON a.label <> b.label JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label
              GROUP BY a.label)
        SELECT {r6('avg(m)')} AS davies_bouldin FROM r"""


def sign_cluster_sql() -> str:
    return "(CAST(embedding[1] > 0 AS INTEGER) + 2 * CAST(embedding[2] > 0 AS INTEGER))"


def sql_contingency() -> str:
    return f"""WITH t AS (SELECT label AS a, {sign_cluster_sql()} AS b FROM embeddings),
        ct AS (SELECT a, b, CAST(count(*) AS DOUBLE) AS nij FROM t GROUP BY a, b),
        ra AS (SELECT a, sum(nij) AS ai FROM ct GROUP BY a), rb AS (SELECT b, sum(nij) AS bj FROM ct GROUP BY b),
        tot AS (SELECT sum(nij) AS n, sum(nij * (nij - 1) / 2) AS sij FROM ct),
        sa AS (SELECT sum(ai * (ai - 1) / 2) AS sa, -sum(ai / (SELECT n FROM tot) * ln(ai / (SELECT n FROM tot))) AS ha,
               count(*) AS ka FROM ra),
        sb AS (SELECT sum(bj * (bj - 1) / 2) AS sb, -sum(bj / (SELECT n FROM tot) * ln(bj / (SELECT n FROM tot))) AS hb,
               count(*) AS kb FROM rb),
        mi AS (SELECT sum(nij / n * ln(n * nij / (ai * bj))) AS mi FROM ct JOIN ra USING (a) JOIN rb USING (b), tot),
        z AS (SELECT *, sa * sb / (n * (n - 1) / 2) AS ex, (sa + sb) / 2 AS mx FROM tot, sa, sb, mi)
        SELECT {r6('CASE WHEN mx = ex THEN 1.0 ELSE (sij - ex) / (mx - ex) END')} AS ari,
               {r6('CASE WHEN ha = 0 AND hb = 0 THEN 1.0 WHEN ha = 0 OR hb = 0 THEN 0.0 ELSE mi / ((ha + hb) / 2) END')} AS nmi,
               CAST(ka AS BIGINT) AS n_clusters_a, CAST(kb AS BIGINT) AS n_clusters_b FROM z"""


def sql_random_projection(dim: int = 64, seed: int = 42) -> str:
    import numpy as np
    w = np.random.default_rng(seed).standard_normal((dim, 2))
    cols = [f"list_dot_product({dbl()}, [{', '.join(repr(float(x)) for x in w[:, j])}]::DOUBLE[])" for j in range(2)]
    return f"SELECT vec_id, label, {lst6('[' + ', '.join(cols) + ']')} AS projection FROM embeddings"


def contrastive_ctes(batch: int = 64, tau: float = 0.1) -> list[str]:
    dotp = "list_sum(list_transform(list_zip(a.z1, b.{v}), lambda p: p[1] * p[2]))"
    return [
        f"""zz AS (SELECT vec_id, label, {l2n(f'{dbl()}[1:32]')} AS z1, {l2n(f'{dbl()}[33:64]')} AS z2,
               CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) / {batch}) AS BIGINT) AS batch_id FROM embeddings)""",
        f"""pr AS (SELECT a.batch_id, a.vec_id AS i, b.vec_id AS j, {dotp.format(v='z2')} / {tau} AS l12,
               {dotp.format(v='z1')} AS c11,
               list_sum(list_transform(list_zip(a.z1, b.z1), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d11
             FROM zz a JOIN zz b ON a.batch_id = b.batch_id)""",
        """rowce AS (SELECT batch_id, i, ln(sum(exp(l12))) - max(CASE WHEN i = j THEN l12 END) AS ce FROM pr GROUP BY batch_id, i)""",
        """colce AS (SELECT batch_id, j, ln(sum(exp(l12))) - max(CASE WHEN i = j THEN l12 END) AS ce FROM pr GROUP BY batch_id, j)""",
        """bs AS (SELECT p.batch_id, CAST(count(DISTINCT p.i) AS BIGINT) AS n,
               ln(avg(exp(-2.0 * greatest(CASE WHEN i = j THEN 0.0 ELSE d11 END, 0.0)))) AS uniformity,
               avg(CASE WHEN i <> j THEN c11 END) AS collapse FROM pr p GROUP BY p.batch_id)""",
        """al AS (SELECT batch_id, avg(list_sum(list_transform(list_zip(z1, z2), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
               AS alignment FROM zz GROUP BY batch_id)""",
        """bt AS (SELECT bs.batch_id, bs.n, 0.5 * (r.ce + c.ce) AS infonce, al.alignment, bs.uniformity, bs.collapse
             FROM bs JOIN (SELECT batch_id, avg(ce) AS ce FROM rowce GROUP BY batch_id) r USING (batch_id)
                     JOIN (SELECT batch_id, avg(ce) AS ce FROM colce GROUP BY batch_id) c USING (batch_id)
                     JOIN al USING (batch_id))""",
    ]


def sql_contrastive_batches() -> str:
    return with_(contrastive_ctes(), f"""SELECT batch_id, n, {r6('infonce')} AS infonce, {r6('alignment')} AS alignment,
        {r6('uniformity')} AS uniformity, {r6('collapse')} AS collapse FROM bt""")


def sql_contrastive_dataset() -> str:
    return with_(contrastive_ctes(), f"""SELECT {r6('avg(CASE WHEN n >= 2 THEN infonce END)')} AS infonce,
        {r6('avg(alignment)')} AS alignment, {r6('avg(uniformity)')} AS uniformity,
        {r6('avg(CASE WHEN n >= 2 THEN collapse END)')} AS collapse, CAST(count(*) AS BIGINT) AS n_batches FROM bt""")


# ------------------------------------------------------------------ lineitem panel (28-day bins, l_suppkey entities)
LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_RANGES = {"l_quantity": (1, 50), "l_discount": (0, 0.1)}


def sql_lineitem_features() -> str:
    stack = " UNION ALL ".join(
        f"SELECT l_suppkey AS id, date_diff('microsecond', TIMESTAMP '1995-01-01 00:00:00', l_shipdate) AS elapsed, "
        f"'{m}' AS parameter, {m} AS value, l_orderkey * 8 + l_linenumber AS ord FROM lineitem" for m in LI)
    cells = ", ".join(f"arg_max(value, ord) FILTER (WHERE parameter = '{m}') AS {m}" for m in LI)
    def rng(m):
        lo, hi = LI_RANGES.get(m, (None, None))
        return f"CASE WHEN {m} >= {lo} AND {m} <= {hi} THEN {m} END" if lo is not None else m
    fills = ", ".join(f"coalesce(quantile_cont({m}, 0.5) FILTER (WHERE split = 'a'), 0.0) AS {m}" for m in LI)
    w = "OVER (PARTITION BY id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ff = ", ".join(f"coalesce(last_value({m} IGNORE NULLS) {w}, (SELECT {m} FROM fill)) AS {m}" for m in LI)
    stats = []
    for m in LI:
        first, last = f"arg_min({m}, period)", f"arg_max({m}, period)"
        slope = f"regr_slope({m}, CAST(period AS DOUBLE))"
        ex = {"first": first, "last": last, "mean": f"avg({m})", "min": f"min({m})", "max": f"max({m})",
              "std": f"stddev_pop({m})", "delta": f"({last} - {first})",
              "slope": f"coalesce(CASE WHEN isnan({slope}) THEN NULL ELSE {slope} END, 0.0)"}
        stats += [f"{r6(clean_num(ex[s]))} AS {m}_{s}" for s in STATS]
    return f"""WITH log AS ({stack}),
    b AS (SELECT id, CAST(ceil(elapsed / {28 * 86400000000}.0) AS BIGINT) AS period, parameter, value, ord FROM log
          WHERE elapsed >= 0 AND value IS NOT NULL),
    cells AS (SELECT id, period, {cells} FROM b WHERE period <= 91 GROUP BY id, period),
    g AS (SELECT e.id, CAST(d.period AS BIGINT) AS period, {', '.join('c.' + m for m in LI)}, {split_expr('e.id')} AS split
          FROM (SELECT DISTINCT id FROM log) e CROSS JOIN generate_series(0, 91) AS d(period)
          LEFT JOIN cells c ON c.id = e.id AND c.period = d.period),
    cl AS (SELECT id, period, {', '.join(rng(m) + ' AS ' + m for m in LI)}, split FROM g),
    fill AS (SELECT {fills} FROM cl),
    ffl AS (SELECT id, period, {ff} FROM cl)
    SELECT id AS l_suppkey, {', '.join(stats)} FROM ffl GROUP BY id"""


# ------------------------------------------------------------------ prompts and answers
def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fill(template: str, **exprs) -> str:
    out, rest = [], template
    while "{" in rest:
        i = rest.index("{")
        j = rest.index("}", i)
        name = rest[i + 1:j]
        if name not in exprs:
            out.append(sql_lit(rest[:j + 1]))
            rest = rest[j + 1:]
            continue
        out.append(sql_lit(rest[:i]))
        out.append(f"({exprs[name]})")
        rest = rest[j + 1:]
    out.append(sql_lit(rest))
    return " || ".join(out)


def ctes_blocks(split: str, name: str) -> list[str]:
    from hourglass.operators.prompts import NO_DYNAMIC, NO_STATIC

    aggs = ", ".join(f"arg_min({c}, CASE WHEN {c} IS NOT NULL THEN day END) AS s_{c}" for c in STATIC)
    aggs += ", " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in EVENT_TYPES)
    s_lines = [
        "CASE WHEN s_acctbal IS NOT NULL THEN '  - Account balance: ' || printf('%.2f', s_acctbal) END",
        "CASE WHEN s_building IS NOT NULL THEN '  - Segment: ' || CASE WHEN s_building = 1 THEN 'Building' ELSE 'Other' END END",
        "CASE WHEN s_nation IS NOT NULL THEN '  - Nation: ' || printf('%.0f', s_nation) END"]
    d_lines = [f"CASE WHEN mn_{c} IS NOT NULL THEN '  - {c}: min=' || printf('%.2f', mn_{c}) || ', max=' || "
               f"printf('%.2f', mx_{c}) END" for c in EVENT_TYPES]
    return [
        f"{name}_a AS (SELECT user_id, {aggs}, arg_min(label, day) AS label FROM ev_clean WHERE split = '{split}' GROUP BY user_id)",
        f"""{name}_b AS (SELECT user_id, coalesce(concat_ws(chr(10), {', '.join(s_lines)}), '') AS sb,
            coalesce(concat_ws(chr(10), {', '.join(d_lines)}), '') AS db, label FROM {name}_a)""",
        f"""{name} AS (SELECT user_id, CASE WHEN sb = '' THEN {sql_lit(NO_STATIC)} ELSE sb END AS static_block,
            CASE WHEN db = '' THEN {sql_lit(NO_DYNAMIC)} ELSE db END AS dynamic_block, label FROM {name}_b)"""]


def sql_patient_blocks() -> str:
    return with_(ctes_grid() + ctes_blocks("c", "blk"), "SELECT * FROM blk")


def prompt_sql(mode: str, shots: str, examples: str | None = None) -> str:
    from hourglass.operators import prompts as P

    intro, instr = (P.BINARY_INTRO, P.BINARY_INSTRUCTIONS) if mode == "binary" else (P.SCALE_INTRO, P.SCALE_INSTRUCTIONS)
    if shots == "zero":
        return sql_fill(intro + P.ZERO_SHOT_BODY + instr, static_block="static_block", dynamic_block="dynamic_block")
    return sql_fill(intro + P.FEW_SHOT_BODY + instr, static_block="static_block", dynamic_block="dynamic_block",
                    examples=examples)


def sql_zero_shot_prompts() -> str:
    return with_(ctes_grid() + ctes_blocks("c", "blk"), f"SELECT *, {prompt_sql('binary', 'zero')} AS prompt FROM blk")


def examples_cte(mode: str) -> list[str]:
    from hourglass.operators import prompts as P

    tgt = P.BINARY_TARGETS if mode == "binary" else P.SCALE_TARGETS
    pred = (f"""'{{"prediction": "' || CASE WHEN label = 1 THEN '{tgt[1]}' ELSE '{tgt[0]}' END || '"}}'"""
            if mode == "binary" else
            f"""'{{"prediction": ' || CASE WHEN label = 1 THEN '{tgt[1]}' ELSE '{tgt[0]}' END || '}}'""")
    text = sql_fill(P.EXAMPLE_BLOCK, static_block="static_block", dynamic_block="dynamic_block", prediction=pred)
    picks = []
    for k, c in enumerate((1, 0)):
        picks.append(f"SELECT * FROM (SELECT *, {k} AS class_order, {draw_rank(42, 'class', 'user_id')} AS h FROM exb "
                     f"WHERE label = {c} ORDER BY h, user_id LIMIT 3)")
    return ctes_blocks("a", "exb") + [
        f"pick AS ({' UNION ALL '.join(picks)})",
        f"ex AS (SELECT string_agg({text}, chr(10) ORDER BY class_order, h, user_id) AS examples FROM pick)"]


def sql_few_shot_examples() -> str:
    return with_(ctes_grid() + examples_cte("binary"), "SELECT examples FROM ex")


def sql_few_shot_prompts() -> str:
    return with_(ctes_grid() + ctes_blocks("c", "blk") + examples_cte("scale"),
                 f"SELECT blk.*, {prompt_sql('scale', 'few', 'ex.examples')} AS prompt FROM blk, ex")


def client_sql(mode: str) -> str:
    if mode == "binary":
        return """CASE WHEN contains(prompt, 'Segment: Building') THEN 'Sure. {"prediction": " Dead "} hope this helps'
                  WHEN contains(prompt, '  - error: ') THEN '{"prediction": "alive"}' ELSE 'no json here' END"""
    return """CASE WHEN contains(prompt, 'Segment: Building') THEN '{"prediction": "9"}'
              WHEN contains(prompt, '  - error: ') THEN '{"prediction": 3}' ELSE '{"prediction": 11}' END"""


def parse_sql(mode: str) -> str:
    j = "(CASE WHEN regexp_extract(trim(response), '(?s)\\{.*?\\}', 0) <> '' THEN regexp_extract(trim(response), '(?s)\\{.*?\\}', 0) ELSE trim(response) END)"
    typ = f"(CASE WHEN json_valid({j}) THEN json_type({j}, '$.prediction') END)"
    val = f"(CASE WHEN json_valid({j}) THEN json_extract_string({j}, '$.prediction') END)"
    if mode == "binary":
        v = f"lower(trim({val}))"
        return f"CASE WHEN {typ} = 'VARCHAR' AND {v} IN ('alive', 'dead') THEN {v} END"
    s = f"trim({val})"
    iv = (f"CASE WHEN {typ} = 'VARCHAR' AND regexp_matches({s}, '^[0-9]+$') THEN TRY_CAST({s} AS INTEGER) "
          f"WHEN {typ} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND regexp_matches({val}, '^-?[0-9]+(\\.0+)?$') "
          f"THEN TRY_CAST(TRY_CAST({val} AS DOUBLE) AS INTEGER) END")
    return f"CASE WHEN ({iv}) BETWEEN 1 AND 10 THEN ({iv}) END"


def answers_ctes(mode: str, shots: str) -> list[str]:
    ctes = ctes_grid() + ctes_blocks("c", "blk")
    if shots == "few":
        ctes += examples_cte(mode)
        p = f"SELECT blk.*, {prompt_sql(mode, 'few', 'ex.examples')} AS prompt FROM blk, ex WHERE blk.label IS NOT NULL"
    else:
        p = f"SELECT blk.*, {prompt_sql(mode, 'zero')} AS prompt FROM blk WHERE blk.label IS NOT NULL"
    return ctes + [f"pr AS ({p})", f"rs AS (SELECT user_id, label, {client_sql(mode)} AS response FROM pr)",
                   f"ans AS (SELECT user_id, label, response, {parse_sql(mode)} AS prediction FROM rs)"]


def sql_model_answers() -> str:
    return with_(answers_ctes("binary", "zero"), "SELECT * FROM ans")


def sql_llm_eval_binary() -> str:
    src = ("(SELECT label, CASE WHEN prediction = 'dead' THEN 1 WHEN prediction = 'alive' THEN 0 ELSE 1 - label END "
           "AS pred, prediction IS NULL AS failed FROM ans)")
    rk = rank_metrics_sql(f"(SELECT CAST(pred AS DOUBLE) AS score, label FROM {src})", [])
    return with_(answers_ctes("binary", "few"), f"""SELECT c.*, {r6(ratio_sql('tp', 'fp'))} AS precision,
        {r6(ratio_sql('tp', 'fn'))} AS recall, {r6(ratio_sql('tn', 'fp'))} AS specificity,
        {r6('r.auroc')} AS auroc, {r6('r.auprc')} AS auprc,
        (SELECT CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) AS BIGINT) FROM {src}) AS failed,
        (SELECT CAST(count(*) AS BIGINT) FROM {src}) AS n_answers
        FROM {conf_sql(src, [])} c, {rk} r""")


def sql_llm_eval_scale() -> str:
    base = ("(SELECT label, coalesce(prediction, CASE WHEN label = 1 THEN 1 ELSE 10 END) AS score, "
            "prediction IS NULL AS failed FROM ans)")
    hard = f"(SELECT CAST(score >= 6 AS INTEGER) AS pred, label FROM {base})"
    rk = rank_metrics_sql(f"(SELECT CAST(pred AS DOUBLE) AS score, label FROM {hard})", [])
    rr = rank_metrics_sql(f"(SELECT (score - 1.0) / 9.0 AS score, label FROM {base})", [], "risk_")
    return with_(answers_ctes("scale", "zero"), f"""SELECT c.*, {r6(ratio_sql('tp', 'fp'))} AS precision,
        {r6(ratio_sql('tp', 'fn'))} AS recall, {r6(ratio_sql('tn', 'fp'))} AS specificity,
        {r6('r.auroc')} AS auroc, {r6('r.auprc')} AS auprc, {r6('q.risk_auroc')} AS risk_auroc,
        {r6('q.risk_auprc')} AS risk_auprc,
        (SELECT CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) AS BIGINT) FROM {base}) AS failed,
        (SELECT CAST(count(*) AS BIGINT) FROM {base}) AS n_answers
        FROM {conf_sql(hard, [])} c, {rk} r, {rr} q""")


# ------------------------------------------------------------------ data quality
def emb_checks_cte() -> list[str]:
    return [
        """ea AS (SELECT count(*) AS n, min(len(embedding)) AS wmin, max(len(embedding)) AS wmax,
              coalesce(sum(len(list_filter(embedding, lambda x: isnan(x) OR isinf(x)))), 0) AS n_bad,
              count(label) AS n_lab, count(TRY_CAST(TRY_CAST(CAST(label AS VARCHAR) AS DOUBLE) AS INTEGER)) AS n_castable
              FROM embeddings)""",
        """cc AS (SELECT count(*) AS n_classes, string_agg(CAST(c AS VARCHAR), ',' ORDER BY CAST(c AS VARCHAR)) AS classes,
              sum(CASE WHEN c NOT IN (0, 1) THEN 1 ELSE 0 END) AS n_non_binary
              FROM (SELECT DISTINCT CAST(label AS INTEGER) AS c FROM embeddings WHERE label IS NOT NULL))""",
        """ck AS (
        SELECT 'non_empty' AS "check", CASE WHEN n > 0 THEN 'OK' ELSE 'FAIL' END AS status, 'n=' || n AS detail FROM ea
        UNION ALL SELECT 'uniform_width', CASE WHEN n > 0 AND wmin = wmax AND wmin > 0 THEN 'OK' ELSE 'FAIL' END,
                  'width=' || wmin || '..' || wmax FROM ea
        UNION ALL SELECT 'numeric', 'OK', 'array<float>'
        UNION ALL SELECT 'finite', CASE WHEN n_bad = 0 THEN 'OK' ELSE 'FAIL' END, 'non_finite=' || n_bad FROM ea
        UNION ALL SELECT 'labels_castable', CASE WHEN n_castable = n_lab THEN 'OK' ELSE 'FAIL' END,
                  'castable=' || n_castable || ' of ' || n_lab FROM ea
        UNION ALL SELECT 'count_match', CASE WHEN n_lab = n THEN 'OK' ELSE 'FAIL' END,
                  'embeddings=' || n || ' labels=' || n_lab FROM ea
        UNION ALL SELECT 'two_classes', CASE WHEN n_classes >= 2 THEN 'OK' ELSE 'FAIL' END, 'classes=[' || classes || ']' FROM cc
        UNION ALL SELECT 'binary_labels', CASE WHEN n_classes = 2 AND n_non_binary = 0 THEN 'OK' ELSE 'WARN' END,
                  'classes=[' || classes || ']' FROM cc
        UNION ALL SELECT 'classes_vs_k', CASE WHEN n_classes >= 2 THEN 'OK' ELSE 'WARN' END, 'classes=' || n_classes || ' k=2' FROM cc
        UNION ALL SELECT 'kmeans_feasible', CASE WHEN n >= 2 THEN 'OK' ELSE 'FAIL' END, 'n=' || n || ' k=2' FROM ea
        UNION ALL SELECT 'tsne_feasible', CASE WHEN n > 30 THEN 'OK' ELSE 'FAIL' END, 'n=' || n || ' perplexity=30' FROM ea)""",
    ]


def sql_embedding_checks() -> str:
    return with_(emb_checks_cte(), 'SELECT * FROM ck')


def sql_embedding_verdict() -> str:
    return with_(emb_checks_cte(), """SELECT CASE WHEN sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) > 0 THEN 'FAIL' ELSE 'OK' END
        AS verdict, CAST(sum(CASE WHEN status = 'WARN' THEN 1 ELSE 0 END) AS BIGINT) AS n_warn,
        CAST(sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS n_fail FROM ck""")


def sql_class_counts() -> str:
    return 'SELECT label AS class, CAST(count(*) AS BIGINT) AS count FROM embeddings GROUP BY label'


def sql_id_agreement() -> str:
    return """SELECT 'left_only' AS side, CAST(count(*) AS BIGINT) AS n_missing FROM
                (SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
              UNION ALL
              SELECT 'right_only', CAST(count(*) AS BIGINT) FROM
                (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))"""


def sql_panel_expectations() -> str:
    return with_(ctes_grid() + [
        "pe AS (SELECT user_id, count(*) AS k, count(DISTINCT day) AS kd FROM ev_grid GROUP BY user_id)",
        "pa AS (SELECT min(k) AS kmin, max(k) AS kmax, CAST(sum(k - kd) AS BIGINT) AS dups FROM pe)"],
        f"""SELECT 'unique_id_time' AS "check", CASE WHEN dups = 0 THEN 'OK' ELSE 'FAIL' END AS status,
              'duplicates=' || dups AS detail FROM pa
            UNION ALL SELECT 'fixed_length', CASE WHEN kmin = 31 AND kmax = 31 THEN 'OK' ELSE 'FAIL' END,
              'rows per id ' || kmin || '..' || kmax || ', expected 31' FROM pa
            UNION ALL SELECT 'feature_count', 'OK', '{len(FEATURES)} of {len(FEATURES)}'
            UNION ALL SELECT 'required_columns', 'OK', 'missing='""")


def sql_grid_invariants() -> str:
    return with_(ctes_grid(), f"""SELECT 'feature_columns' AS "check", true AS ok, '{len(FEATURES)} of {len(FEATURES)}' AS detail
        UNION ALL SELECT 'rows_per_entity', count(*) = count(DISTINCT user_id) * 31,
          printf('rows=%d ids=%d steps=%d', count(*), count(DISTINCT user_id), 31) FROM ev_grid""")


def sql_unique_ids() -> str:
    return with_(ctes_ffill(), """SELECT 'unique_ids' AS "check", CASE WHEN count(*) = count(DISTINCT user_id) THEN 'OK'
        ELSE 'FAIL' END AS status, 'rows=' || count(*) || ' ids=' || count(DISTINCT user_id) AS detail
        FROM (SELECT user_id FROM ev_ffill GROUP BY user_id)""")


# ------------------------------------------------------------------ sources and sinks
def sql_raw_log_grid() -> str:
    """Grid from per-user logs: minute clock (truncated), daily ceil bins of 1440 minutes, statics read at
    00:00 from the customer values, users of the HOUSEHOLD segment quarantined (no RecordID)."""
    cells = ",\n      ".join(f"nullif(arg_max(value, ord) FILTER (WHERE parameter = '{p}'), 'nan'::DOUBLE) AS {p}" for p in EVENT_TYPES)
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return f"""WITH good AS (SELECT DISTINCT e.user_id AS id FROM events e JOIN customer c ON c.c_custkey = e.user_id
                         WHERE c.c_mktsegment <> 'HOUSEHOLD' AND e.user_id % 11 NOT IN (5, 7)),
    lg AS (SELECT user_id AS id, CAST(floor(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 60000000) AS BIGINT) AS m,
                  event_type AS parameter, CASE WHEN event_id % 97 = 0 THEN 'nan'::DOUBLE WHEN value < 1 THEN -1.0 ELSE value END AS value, event_id AS ord FROM events),
    bn AS (SELECT id, CAST(ceil(m / 1440.0) AS BIGINT) AS day, parameter, value, ord FROM lg WHERE m >= 0 AND value <> -1.0),
    cells AS (SELECT id, day, {cells} FROM bn WHERE day <= 30 GROUP BY id, day),
    st AS (SELECT c_custkey AS id, CASE WHEN c_acctbal <> -1.0 THEN c_acctbal END AS acctbal,
                  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS building,
                  CASE WHEN c_nationkey <> -1 THEN CAST(c_nationkey AS DOUBLE) END AS nation FROM customer),
    {ctes_grid()[4]},
    g AS (SELECT e.id AS user_id, CAST(d.day AS BIGINT) AS day, s.acctbal, s.building, s.nation,
                 {", ".join("c." + p for p in EVENT_TYPES)}, l.label, {split_expr("e.id")} AS split
          FROM good e CROSS JOIN generate_series(0, 30) AS d(day)
          LEFT JOIN st s ON s.id = e.id LEFT JOIN ev_labels l ON l.id = e.id
          LEFT JOIN cells c ON c.id = e.id AND c.day = d.day)
    SELECT user_id, day, {cols}, label, split FROM g"""


def sql_raw_log_rejects() -> str:
    return """SELECT DISTINCT e.user_id AS entity, CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'no RecordID row'
                 WHEN e.user_id % 11 = 5 THEN 'non-numeric static acctbal' ELSE 'malformed time' END AS reason
              FROM events e JOIN customer c ON c.c_custkey = e.user_id
              WHERE c.c_mktsegment = 'HOUSEHOLD' OR e.user_id % 11 IN (5, 7)"""


def sql_embedding_manifest() -> str:
    return f"""SELECT {split_expr('vec_id')} AS split, CAST(count(*) AS BIGINT) AS n, CAST(max(len(embedding)) AS INTEGER) AS dim,
        CAST(count(label) AS BIGINT) AS n_labelled, true AS has_ids FROM embeddings GROUP BY 1"""


def sql_positional_embeddings() -> str:
    return f"SELECT {lst6(dbl())} AS embedding, label, vec_id FROM embeddings"


def sql_panel_roundtrip() -> str:
    cols = ", ".join(r6(c) + " AS " + c for c in FEATURES)
    return with_(ctes_ffill(), f"SELECT user_id, day, {cols}, label, split FROM ev_ffill")


# ------------------------------------------------------------------ remaining single operators
def sql_pos_weight() -> str:
    return with_(ctes_grid(), """SELECT CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
        CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
        CASE WHEN sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) > 0
             THEN round(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN label = 1 THEN 1 ELSE 0 END), 6)
             ELSE 1.0 END AS pos_weight
        FROM (SELECT DISTINCT user_id, label FROM ev_grid WHERE split = 'a')""")


def sql_standard_scaled() -> str:
    names = feature_names()
    feat = f"feat AS (SELECT user_id, {', '.join(clean_num(n) + ' AS ' + n for n in names)}, label, " \
           f"{split_expr('user_id')} AS split FROM ({feat_stats_sql('ev_ffill')}))"
    par = ", ".join(f"avg({n}) FILTER (WHERE split = 'a') AS {n}__m, stddev_pop({n}) FILTER (WHERE split = 'a') AS {n}__s"
                    for n in names)
    cols = ", ".join(f"{r6(f'(f.{n} - p.{n}__m) / (CASE WHEN p.{n}__s IS NULL OR p.{n}__s = 0 THEN 1.0 ELSE p.{n}__s END)')} AS {n}"
                     for n in names)
    return with_(ctes_ffill() + [feat, f"par AS (SELECT {par} FROM feat)"],
                 f"SELECT f.user_id, {cols}, f.label, f.split FROM feat f CROSS JOIN par p")


def sql_static_normalize() -> str:
    cols = []
    for c in STATIC:
        if c == "building":
            cols.append(f"{r6('arg_min(building, day)')} AS building")
        else:
            iqr = f"(CASE WHEN p.{c}__iqr0 IS NULL OR p.{c}__iqr0 = 0 THEN 1.0 ELSE p.{c}__iqr0 END)"
            cols.append(f"{r6(f'(arg_min(g.{c}, g.day) - any_value(p.{c}__med)) / (any_value({iqr}) + 1e-8)')} AS {c}")
    return with_(ctes_linear(), f"SELECT g.user_id, {', '.join(cols)} FROM ev_ffill g CROSS JOIN ev_par p GROUP BY g.user_id")


def sql_missingness() -> str:
    return f"SELECT \"column\", missing_pct FROM ({sql_column_profile()})"


def sql_subset_ids() -> str:
    return f"""SELECT doc_id, lang, source, n_chars, -doc_id AS position FROM documents WHERE doc_id IN
        (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM documents) ORDER BY {draw_rank(42, 'budget-100', 'doc_id')}, doc_id LIMIT 100)"""


def sql_masked_mean() -> str:
    dims = ["t_scaled", "value_scaled"] + [f"CAST(var_idx = {i} AS DOUBLE)" for i in range(len(FEATURES))]
    # summed in sequence order (deterministic, like the per-row array fold) rather than a parallel avg
    sums = ", ".join(f"list_sum(list({d} ORDER BY t_scaled, var_idx)) / count(*)" for d in dims)
    return with_(ctes_tokens(), f"SELECT user_id, {lst6('[' + sums + ']')} AS pooled FROM ev_tokens GROUP BY user_id")


def sql_tokens_non_empty() -> str:
    return with_(ctes_tokens(), """SELECT 'tokens_non_empty' AS "check", count(*) > 0 AS ok,
        printf('%d tokens', count(*)) AS detail FROM ev_tokens""")


def sql_side_by_side() -> str:
    return f"SELECT vec_id AS id, {lst6(dbl())} AS embedding, label, {sign_cluster_sql()} AS cluster FROM embeddings"


def sql_positions() -> str:
    """Q8: each fixed-sequence row plus sin/cos position features (base 10000; sin on even dims)."""
    d = float(len(FEATURES))
    row = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURES) + "]"
    pe = (f"CASE WHEN (k - 1) % 2 = 0 THEN sin((p - 1) / pow(10000.0, ((k - 1) - (k - 1) % 2) / {d})) "
          f"ELSE cos((p - 1) / pow(10000.0, ((k - 1) - (k - 1) % 2) / {d})) END")
    added = f"list_transform(seq, lambda r, p: list_transform(r, lambda x, k: x + {pe}))"
    return with_(ctes_linear() + [f"sq AS (SELECT user_id, list({row} ORDER BY day) AS seq FROM ev_linear GROUP BY user_id)"],
                 f"SELECT user_id, {lst6_2(added)} AS seq FROM sq")


def sql_score_with() -> str:
    """The user model is a logistic function of the last-state features with linspace(-1, 1) weights."""
    import numpy as np

    w = np.linspace(-1.0, 1.0, len(FEATURES))
    last = {c: f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN day END)" for c in FEATURES}
    dotp = " + ".join(f"coalesce({last[c]}, 0.0) * {float(wi)!r}" for c, wi in zip(FEATURES, w))
    return with_(ctes_linear(), f"""SELECT user_id, arg_min(label, day) AS label,
        {r6(f'1.0 / (1.0 + exp(-({dotp}) / 100.0))')} AS y_prob FROM ev_linear GROUP BY user_id""")


def sql_concat_features() -> str:
    """Q4: linear values, then masks, then deltas (raw clean panel) for each (user, day)."""
    w = "OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    masks = [f"CAST({c} IS NOT NULL AS DOUBLE)" for c in FEATURES]
    deltas = [f"CAST(coalesce(day - last_value(CASE WHEN {c} IS NOT NULL THEN day END IGNORE NULLS) {w}, day + 1) AS DOUBLE)"
              for c in FEATURES]
    return with_(ctes_linear() + [f"md AS (SELECT user_id, day, [{', '.join(masks)}] AS m, [{', '.join(deltas)}] AS d FROM ev_clean)"],
                 f"""SELECT l.user_id, l.day, {lst6(f"list_concat([{', '.join('CAST(l.' + c + ' AS DOUBLE)' for c in FEATURES)}], md.m, md.d)")} AS x
                 FROM ev_linear l JOIN md ON l.user_id = md.user_id AND l.day = md.day""")


# ------------------------------------------------------------------ operators with a query of their own
def sql_outcomes_scan() -> str:
    return with_(ctes_grid(), "SELECT id, label FROM ev_labels")


def sql_variable_map() -> str:
    parts = [f"""SELECT '{c}' AS variable, {i} AS "index", 'var_{c}' AS ohe_column, '{'static' if c in STATIC else 'dynamic'}' AS role,
        {str(c == 'building').lower()} AS is_binary, {str(c in LOG_COLS).lower()} AS use_log1p,
        {r6(f'(count(*) - count({c})) * 100.0 / count(*)')} AS missing_pct FROM ev_grid""" for i, c in enumerate(FEATURES)]
    return with_(ctes_grid(), "\nUNION ALL\n".join(parts))


def sql_entity_rows() -> str:
    return f"SELECT * FROM ({sql_grid()}) WHERE label = 1"


def sql_experiment_grid() -> str:
    """The fixed experiments (a parameter of the library) with the labelled users per split."""
    import json

    from hourglass.plans import models as M

    rows = []
    for model, grid in (("lstm", M.SEQUENCE_GRID), ("transformer", M.TRANSFORMER_GRID), ("lr", M.LR_GRID), ("rf", M.RF_GRID),
                        ("gbt", M.GBT_GRID), ("rf_engineered", M.RF_ENGINEERED_GRID)):
        for i, c in enumerate(grid):
            width = len(FEATURES) * (3 if c.get("mask_delta") else 1)
            rows.append(f"('{model}', {i}, '{json.dumps(c, sort_keys=True)}', {width})")
    counts = ", ".join(f"(SELECT CAST(count(DISTINCT user_id) AS BIGINT) FROM ev_grid WHERE label IS NOT NULL AND split = '{s}') AS {c}"
                       for s, c in (("a", "n_train"), ("b", "n_val"), ("c", "n_test")))
    return with_(ctes_grid(), f"""SELECT model, cfg_idx, config, n_features, {counts}
        FROM (VALUES {", ".join(rows)}) AS t(model, cfg_idx, config, n_features)""")


def sql_augment(seed: int = 42, crop: int = 16, noise: float = 0.05, drop: float = 0.1, steps: int = 31) -> str:
    def unit(tag: str, *parts: str) -> str:
        text = f"'{seed}|{tag}|' || " + " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
        return f"((CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) + 1) / 4503599627370497.0)"

    views = []
    for v in (0, 1):
        row = ", ".join(f"""CASE WHEN {unit(f'drop-{v}', 'user_id', str(d))} < {drop} THEN 0.0 ELSE CAST({c} AS DOUBLE) + {noise}
            * sqrt(-2.0 * ln({unit(f'u1-{v}', 'user_id', 'i', str(d))})) * cos(2 * pi() * {unit(f'u2-{v}', 'user_id', 'i', str(d))}) END"""
                        for d, c in enumerate(FEATURES))
        views.append(f"""v{v} AS (SELECT user_id, {lst6_2(f'list([{row}] ORDER BY i)')} AS view{v} FROM (
            SELECT *, day - {draw_rank(seed, f'crop-{v}', 'user_id')} % {steps - crop + 1} AS i FROM ev_linear)
            WHERE i >= 0 AND i < {crop} GROUP BY user_id)""")
    return with_(ctes_linear() + views, "SELECT v0.user_id, view0, view1 FROM v0 JOIN v1 ON v0.user_id = v1.user_id")


def sql_summary_json() -> str:
    names = ("cfg_idx", "config_name", "val_auroc", "val_auprc", "test_auroc", "test_auprc")
    fields = ", ".join(f"'{n}': {n}" for n in names)
    return "SELECT CAST(to_json({" + fields + "}) AS VARCHAR) AS json FROM (" + sql_leaderboard() + ")"


# ------------------------------------------------------------------ stores with faults, documents, the ledger
def sql_store_report() -> str:
    return """SELECT 'good' AS store, 'OK' AS status, CAST(count(*) AS BIGINT) AS n_rows, 'vec_id,embedding,label' AS columns,
            CAST(0 AS BIGINT) AS n_bad_files FROM embeddings
        UNION ALL SELECT 'absent', 'MISSING', NULL, NULL, 0
        UNION ALL SELECT 'truncated', 'UNREADABLE', NULL, NULL, 1"""


def sql_store_checks() -> str:
    return with_(emb_checks_cte(), """SELECT 'good' AS store, "check", status FROM ck
        UNION ALL SELECT 'good', unnest(['exists', 'readable', 'columns']), 'OK'
        UNION ALL SELECT 'absent', 'exists', 'FAIL'
        UNION ALL SELECT 'truncated', 'exists', 'OK' UNION ALL SELECT 'truncated', 'readable', 'FAIL'""")


def sql_summary_document() -> str:
    return f"""SELECT *, 'quality' AS task, 2 AS n_metrics, CAST(NULL AS DOUBLE) AS best_so_far FROM ({sql_leaderboard()})"""


def sql_ledger_answers() -> str:
    return with_(answers_ctes("binary", "zero"), "SELECT *, CAST(0 AS BIGINT) AS asked_again FROM ans")
