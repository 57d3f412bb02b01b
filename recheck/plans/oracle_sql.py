"""DuckDB oracle pieces shared by several queries (the oracle side only; never used by the Spark plans)."""

from __future__ import annotations


def nz_text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'nan')"


def key_sql(cols, variant: str) -> str:
    texts = [nz_text(c) for c in cols]
    if variant == "ascii_lower":
        return f"regexp_replace(lower(concat({', '.join(texts)})), '[^A-Za-z0-9]', '', 'g')"
    if variant == "ascii_case":
        return f"regexp_replace(concat_ws('-', {', '.join(texts)}), '[^A-Za-z0-9]', '', 'g')"
    if variant == "unicode_lower":
        return "concat(" + ", ".join(f"lower(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
                                     for t in texts) + ")"
    raise ValueError(variant)


def greedy_ctes(left: str, right: str, key_l: str, key_r: str, cols: list[str], cmp_l: list[str],
                cmp_r: list[str], order_l: list[str], order_r: list[str], raw_l: list[str] | None = None,
                raw_r: list[str] | None = None) -> list[tuple[str, str]]:
    """Recursive CTEs replaying the greedy matcher one left row per key per step.

    ``st`` ends with one row per left row (i > 0): pid, k, matched, consumed, diff (VARCHAR[] in column order).
    With ``raw_l``/``raw_r`` a sole remaining candidate whose raw cells all equal the left row's (and hold no NULL)
    is matched but not consumed.
    """
    ol = ", ".join([f"{c} ASC NULLS LAST" for c in order_l] + ["row_id"])
    orr = ", ".join([f"{c} ASC NULLS LAST" for c in order_r] + ["row_id"])
    pc = ", ".join(f"{e} AS c{i}" for i, e in enumerate(cmp_l))
    gc = ", ".join(f"{e} AS c{i}" for i, e in enumerate(cmp_r))
    dl = ", ".join(f"CASE WHEN p.c{i} IS DISTINCT FROM g.c{i} THEN '{c}' END" for i, c in enumerate(cols))
    if raw_l is not None:
        pc += ", " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(raw_l))
        gc += ", " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(raw_r))
        ex = " AND ".join(f"(g.x{i} IS NOT NULL AND p.x{i} IS NOT DISTINCT FROM g.x{i})" for i in range(len(cols)))
    else:
        ex = "false"
    return [
        ("p", f"SELECT {key_l} AS k, row_id AS id, {pc}, row_number() OVER (PARTITION BY {key_l} ORDER BY {ol}) AS rn "
              f"FROM {left}"),
        ("g", f"SELECT {key_r} AS k, row_id AS id, {gc}, row_number() OVER (PARTITION BY {key_r} ORDER BY {orr}) AS go "
              f"FROM {right}"),
        ("e", f"SELECT p.id AS pid, g.id AS gid, g.go, list_filter([{dl}], lambda z: z IS NOT NULL) AS d, "
              f"({ex}) AS ex FROM p JOIN g ON p.k = g.k"),
        ("st(k, i, used, pid, matched, consumed, diff)", """
  SELECT DISTINCT k, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR[]) FROM p
  UNION ALL
  SELECT k, rn, CASE WHEN c IS NULL THEN used ELSE list_append(used, c) END, pid, l[1].id, c, l[1].d
  FROM (SELECT *, CASE WHEN len(l) = 1 AND l[1].ex THEN NULL
                       ELSE list_filter(l, lambda z: z.d = l[1].d)[-1].id END AS c FROM (
        SELECT st.k, pp.rn, st.used, pp.id AS pid,
          list({'n': len(e.d), 'o': e.go, 'id': e.gid, 'd': e.d, 'ex': e.ex} ORDER BY len(e.d), e.go)
            FILTER (WHERE e.gid IS NOT NULL AND NOT list_contains(st.used, e.gid)) AS l
        FROM st JOIN p pp ON pp.k = st.k AND pp.rn = st.i + 1 LEFT JOIN e ON e.pid = pp.id
        GROUP BY st.k, pp.rn, st.used, pp.id) x) y"""),
    ]
