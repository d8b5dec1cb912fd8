"""SQL for the operator queries."""

LI = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) rn FROM lineitem) t WHERE rn = 1)"""

PV = """(SELECT p_partkey pid, p_size, v.v ver, v.sd, v.ed,
  cast(cast(p_retailprice AS decimal(19,4)) * v.f AS decimal(19,4)) cost
FROM part CROSS JOIN (
  SELECT 1 v, timestamp '1995-01-01 00:00:00' sd, timestamp '1997-05-29 00:00:00' ed, cast(0.8 AS decimal(4,2)) f
  UNION ALL SELECT 2, timestamp '1997-05-30 00:00:00', timestamp '1999-05-29 00:00:00', cast(0.9 AS decimal(4,2))
  UNION ALL SELECT 3, timestamp '1999-05-30 00:00:00', cast(NULL AS timestamp), cast(1.0 AS decimal(4,2))) v
WHERE p_size >= 6)"""

GAPS = f"""(SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END qty FROM {LI} x)"""

CHECKED = f"""(SELECT l.l_orderkey, l.l_linenumber, l.qty, l.l_shipdate, o.o_orderdate
  FROM {GAPS} l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
PASSES = "(qty >= 0) AND (l_shipdate >= o_orderdate)"

MT = """(SELECT row_number() OVER (ORDER BY c_custkey) k, c_custkey id, c_name nm
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""
MS = "(SELECT c_custkey id, concat(c_name, '*') nm FROM customer WHERE c_acctbal >= 0)"

SUPPLIERS = """SELECT CASE WHEN s_acctbal >= 1000 THEN s_suppkey END k, s_name n, s_nationkey, 1 here FROM supplier"""
FEED_ROWS = """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END k, o_custkey c, o_totalprice p,
  o_orderpriority q, o_orderkey n FROM orders"""
FEED_OLD = f"(SELECT * FROM ({FEED_ROWS}) r WHERE n % 13 <> 0)"
FEED_NEW = f"""(SELECT k, c, CASE WHEN n % 5 = 0 THEN p + 1 ELSE p END p, CASE WHEN n % 7 <> 0 THEN q END q, n
  FROM ({FEED_ROWS}) r WHERE n % 17 <> 0)"""

NULL_KEY_COUNTS = """SELECT '{mode}' m, count(CASE WHEN t.here IS NULL THEN 1 END) inserted,
  count(CASE WHEN t.here IS NOT NULL AND s.here IS NOT NULL THEN 1 END) updated,
  count(CASE WHEN s.here IS NULL THEN 1 END) deleted
FROM ({suppliers} WHERE s_nationkey <> 2) s
FULL JOIN ({suppliers} WHERE s_nationkey <> 1) t ON {match}"""

VALID = "o.o_orderdate BETWEEN v.sd AND coalesce(v.ed, timestamp '2002-01-01 00:00:00')"

FACT = f"""SELECT concat('SO', cast(o.o_orderkey AS varchar)) son,
  cast(row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, v.ver) AS int) ln,
  cast(strftime(o.o_orderdate, '%Y%m%d') AS int) odk, v.ver pk, cast(l.l_quantity AS smallint) qty,
  cast(l.l_extendedprice AS decimal(19,4)) ext,
  cast(cast(l.l_discount AS decimal(19,4)) * cast(l.l_extendedprice AS decimal(19,4)) AS decimal(38,8)) da,
  cast(cast(l.l_extendedprice AS decimal(19,4)) - cast(l.l_discount AS decimal(19,4))
    * cast(l.l_extendedprice AS decimal(19,4)) AS decimal(19,4)) sa,
  cast(cast(l.l_quantity AS smallint) * v.cost AS decimal(19,4)) tpc
FROM {LI} l JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus = 'F'
LEFT JOIN {PV} v ON l.l_partkey = v.pid AND {VALID}"""

SIZES = """SELECT source,
  min_by(n_chars, doc_id) FILTER (WHERE lang = 'en') en,
  min_by(n_chars, doc_id) FILTER (WHERE lang = 'fr') fr,
  min_by(n_chars, doc_id) FILTER (WHERE lang = 'de') de,
  min_by(n_chars, doc_id) FILTER (WHERE lang = 'es') es
FROM documents GROUP BY source"""

# Spanish and French names, Monday first and January first.
DAYS_ES = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"
DAYS_FR = "['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche']"
MONTHS_ES = (
    "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',"
    "'Noviembre','Diciembre']"
)
MONTHS_FR = (
    "['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre',"
    "'Novembre','Décembre']"
)

OPERATOR_ORACLES = {
    "dedup_latest": f"SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM {LI} t",
    "dedup_nulls_last": """
        SELECT user_id, event_type, event_id, value FROM (
          SELECT user_id, event_type, event_id, nullif(value, 0.02) value,
            row_number() OVER (PARTITION BY user_id, event_type
              ORDER BY nullif(value, 0.02) DESC NULLS LAST, event_id DESC) rn FROM events) t
        WHERE rn = 1""",
    "dedup_load_time": """
        SELECT user_id, event_id, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) rn
          FROM events) t
        WHERE rn = 1""",
    "one_per_key": """
        SELECT n_regionkey, n_nationkey, n_name FROM nation n
        WHERE n_nationkey = (SELECT min(m.n_nationkey) FROM nation m WHERE m.n_regionkey = n.n_regionkey)""",
    "fill_defaults": """
        SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') seg,
          coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0.0) bal FROM customer""",
    "fill_typed": """
        SELECT c_custkey, coalesce(CASE WHEN c_nationkey < 12 THEN c_acctbal >= 0 END, true) flag,
          coalesce(CASE WHEN c_nationkey > 8 THEN timestamp '1999-01-01 00:00:00' END,
            timestamp '2002-01-01 00:00:00') ts,
          trim(concat('  ', c_mktsegment, ' ')) seg FROM customer""",
    "fill_row_id": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE
          regexp_replace(md5(concat('orders|', length(cast(o_orderkey AS varchar)), ':', cast(o_orderkey AS varchar))),
            '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END rowguid
        FROM orders""",
    "fill_row_id_composite": """
        SELECT doc_id, CASE WHEN a IS NOT NULL THEN regexp_replace(md5(concat('documents|',
            length(a), ':', a, CASE WHEN b IS NULL THEN '-' ELSE concat(length(b), ':', b) END)),
            '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END rowguid
        FROM (SELECT doc_id, concat(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, '|') a,
          CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN '' ELSE concat(source, '|') END b
          FROM documents) t""",
    "number_events": """
        SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) n
        FROM events""",
    "account_number": """
        SELECT c_custkey, concat('AW', right(concat('00000000', cast(c_custkey AS varchar)), 8)) acct
        FROM customer""",
    "guarded_total": f"""
        SELECT l_orderkey, l_linenumber,
          CASE WHEN qty * l_extendedprice * (1.0 - l_discount) IS NULL THEN 0.0 ELSE l_extendedprice END lt
        FROM {GAPS} t""",
    "checks_accept": f"SELECT * FROM {CHECKED} x WHERE {PASSES}",
    "checks_reject_false": f"SELECT * FROM {CHECKED} x WHERE NOT ({PASSES})",
    "checks_quarantine": f"""
        SELECT *, concat_ws(',', CASE WHEN coalesce(qty >= 0, false) THEN NULL ELSE 'quantity' END,
          CASE WHEN coalesce(l_shipdate >= o_orderdate, false) THEN NULL ELSE 'ship_date' END) failed
        FROM {CHECKED} x WHERE coalesce({PASSES}, false) = false""",
    "checks_counts": f"""
        WITH c AS (SELECT l_orderkey, l_linenumber, unnest([
            CASE WHEN coalesce(qty >= 0, false) THEN NULL ELSE 'quantity' END,
            CASE WHEN coalesce(l_shipdate >= o_orderdate, false) THEN NULL ELSE 'ship_date' END,
            CASE WHEN o_orderdate IS NOT NULL THEN NULL ELSE 'order_date' END]) name FROM {CHECKED} x)
        SELECT a.n check_name, count(name) failed,
          min(spot).k first_l_orderkey, min(spot).n first_l_linenumber, max(spot).k last_l_orderkey, max(spot).n last_l_linenumber
        FROM (SELECT unnest(['quantity', 'ship_date', 'order_date']) n) a LEFT JOIN
          (SELECT name, {{'k': l_orderkey, 'n': l_linenumber}} spot FROM c WHERE name IS NOT NULL) b ON a.n = name
        GROUP BY a.n""",
    "required_columns": """
        SELECT 'l_quantity' AS "column", count(*) - count(nullif(l_quantity, 1.0)) missing FROM lineitem
        UNION ALL
        SELECT 'l_discount', count(*) - count(nullif(l_discount, 0.0)) FROM lineitem""",
    "cast_to_schema": """
        SELECT o_orderkey k, cast(o_totalprice AS decimal(19,4)) t, cast(o_orderdate AS date) d,
          cast(substring(o_orderpriority, 1, 1) AS tinyint) p FROM orders""",
    "schema_report": """
        SELECT 'o_orderkey' AS "column", 'different type' problem, 'bigint' actual, 'int' expected,
          count(o_orderkey) filled FROM orders
        UNION ALL
        SELECT 'o_totalprice', 'different type', 'double', 'decimal(19,4)', count(o_totalprice) FROM orders
        UNION ALL
        SELECT 'o_orderpriority', 'not expected', 'string', NULL, count(o_orderpriority) FROM orders""",
    "merge_identity": f"""
        SELECT coalesce(t.k, (SELECT max(k) FROM {MT} m)
          + row_number() OVER (PARTITION BY t.k IS NULL ORDER BY s.id)) k, s.id, s.nm
        FROM {MS} s LEFT JOIN {MT} t ON t.id = s.id""",
    "merge_counts": f"""
        SELECT count(CASE WHEN t.id IS NULL THEN 1 END) inserted,
          count(CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 1 END) updated,
          count(CASE WHEN s.id IS NULL THEN 1 END) deleted
        FROM {MS} s FULL JOIN {MT} t ON t.id = s.id""",
    "merge_feed": f"""
        SELECT s.k, s.c, s.p, s.q, s.n, CASE WHEN t.n IS NULL THEN 'inserted' ELSE 'changed' END change
        FROM {FEED_NEW} s LEFT JOIN {FEED_OLD} t ON s.k = t.k AND s.n = t.n
        WHERE t.n IS NULL OR s.p <> t.p OR s.q IS DISTINCT FROM t.q
        UNION ALL
        SELECT t.k, NULL, NULL, NULL, t.n, 'deleted'
        FROM {FEED_OLD} t LEFT JOIN {FEED_NEW} s ON s.k = t.k AND s.n = t.n WHERE s.n IS NULL""",
    "merge_feed_applied": f"SELECT * FROM {FEED_NEW} s",
    "merge_feed_counts": f"""
        WITH s AS (SELECT c, k, count(*) n, string_agg(concat_ws('|', p, coalesce(q, '-'), n), ';' ORDER BY n) r
          FROM {FEED_NEW} a GROUP BY 1, 2), t AS (
          SELECT c, k, count(*) n, string_agg(concat_ws('|', p, coalesce(q, '-'), n), ';' ORDER BY n) r
          FROM {FEED_OLD} a GROUP BY 1, 2)
        SELECT CASE WHEN t.n IS NULL THEN 'inserted' WHEN s.r = t.r THEN 'unchanged' ELSE 'changed' END change,
          cast(sum(s.n) AS bigint) n
        FROM s LEFT JOIN t ON s.c = t.c AND s.k = t.k GROUP BY 1
        UNION ALL
        SELECT 'deleted', cast(sum(t.n) AS bigint)
        FROM t LEFT JOIN s ON s.c = t.c AND s.k = t.k WHERE s.n IS NULL""",
    "merge_null_keys": NULL_KEY_COUNTS.format(
        mode="plain", suppliers=SUPPLIERS, match="s.k = t.k AND s.n = t.n"
    )
    + " UNION ALL "
    + NULL_KEY_COUNTS.format(
        mode="null_safe", suppliers=SUPPLIERS, match="s.k IS NOT DISTINCT FROM t.k AND s.n = t.n"
    ),
    "merge_null_safe_identity": f"""
        WITH s AS ({SUPPLIERS}), t AS (
          SELECT row_number() OVER (ORDER BY k NULLS FIRST, n) id, k, n FROM s WHERE s_nationkey <> 1)
        SELECT coalesce(t.id, (SELECT max(id) FROM t)
          + row_number() OVER (PARTITION BY t.id IS NULL ORDER BY s.k NULLS FIRST, s.n)) id, s.k, s.n, s.s_nationkey
        FROM s LEFT JOIN t ON s.k IS NOT DISTINCT FROM t.k AND s.n = t.n WHERE s.s_nationkey <> 2""",
    "merge_null_safe_duplicates": f"""
        SELECT k, s_nationkey, count(*) n FROM ({SUPPLIERS}) s GROUP BY 1, 2 HAVING count(*) > 1""",
    "merge_duplicate_source": """
        SELECT l_orderkey, l_linenumber, count(*) n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "bronze_load": """
        SELECT o_orderkey, o_orderpriority, timestamp '2002-01-01 00:00:00' _process_timestamp,
          true from_file
        FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "schema_evolution": """
        SELECT o_orderkey, o_totalprice, cast(NULL AS varchar) o_orderstatus, o_orderpriority FROM orders""",
    "dim_date": f"""
        SELECT cast(strftime(d, '%Y%m%d') AS int) "DateKey", cast(d AS date) "FullDateAlternateKey",
          cast(dayofweek(d) + 1 AS int) "DayNumberOfWeek", dayname(d) "EnglishDayNameOfWeek",
          {DAYS_ES}[isodow(d)] "SpanishDayNameOfWeek", {DAYS_FR}[isodow(d)] "FrenchDayNameOfWeek",
          cast(dayofmonth(d) AS int) "DayNumberOfMonth", cast(dayofyear(d) AS int) "DayNumberOfYear",
          cast(weekofyear(d) AS int) "WeekNumberOfYear", monthname(d) "EnglishMonthName",
          {MONTHS_ES}[month(d)] "SpanishMonthName", {MONTHS_FR}[month(d)] "FrenchMonthName",
          cast(month(d) AS int) "MonthNumberOfYear", cast(quarter(d) AS int) "CalendarQuarter",
          cast(year(d) AS int) "CalendarYear", CASE WHEN quarter(d) <= 2 THEN 1 ELSE 2 END "CalendarSemester",
          cast((quarter(d) + 2 - 1) % 4 + 1 AS int) "FiscalQuarter",
          cast(CASE WHEN (quarter(d) + 2 - 1) % 4 + 1 = 1 THEN year(d) + 1 ELSE year(d) END AS int) "FiscalYear",
          CASE WHEN (quarter(d) + 2 - 1) % 4 + 1 <= 2 THEN 1 ELSE 2 END "FiscalSemester",
          coalesce(n, 0) orders
        FROM (SELECT unnest(generate_series(
          (SELECT date_trunc('year', min(o_orderdate)) FROM orders),
          (SELECT date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day FROM orders),
          interval 1 day)) d) t
        LEFT JOIN (SELECT cast(o_orderdate AS date) od, count(*) n FROM orders GROUP BY 1) o
          ON o.od = cast(d AS date)""",
    "dim_territory": """
        SELECT n_nationkey a, n_name b, r_name c, cast(NULL AS varchar) d
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_promotion": """
        SELECT row_number() OVER (ORDER BY l_discount) k, cast(round(l_discount * 100) AS int) ak,
          concat('Discount ', cast(cast(round(l_discount * 100) AS int) AS varchar)) nm,
          cast(NULL AS varchar) es
        FROM (SELECT DISTINCT l_discount FROM lineitem) d""",
    "dim_customer": """
        SELECT c_custkey k, concat('AW', right(concat('00000000', cast(c_custkey AS varchar)), 8)) ak,
          c_name, n_name, r_name, o.fd, cast(NULL AS varchar) x
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT o_custkey, cast(min(o_orderdate) AS date) fd FROM orders GROUP BY o_custkey) o
          ON c_custkey = o.o_custkey""",
    "pivot_first": SIZES,
    "strip_names": """
        SELECT source, count(CASE WHEN lang = 'en' THEN 1 END) en, count(CASE WHEN lang = 'fr' THEN 1 END) fr,
          count(CASE WHEN lang = 'de' THEN 1 END) de, count(CASE WHEN lang = 'es' THEN 1 END) es
        FROM documents GROUP BY source""",
    "history_join": f"""
        SELECT a.pid, a.sd, a.ed, a.cost, b.cost lp
        FROM {PV} a LEFT JOIN (SELECT * FROM {PV} z WHERE ver <> 2) b
          ON a.pid = b.pid AND a.sd = b.sd AND (a.ed = b.ed OR (a.ed IS NULL AND b.ed IS NULL))""",
    "dim_product": f"""
        SELECT concat('PN-', cast(p.p_partkey AS varchar)) pn, p.p_name, v.cost, v.sd, v.ed,
          CASE WHEN v.ed IS NULL THEN 'Current' END st, d.en, d.fr, d.de, d.es es_chars
        FROM part p LEFT JOIN {PV} v ON p.p_partkey = v.pid
        LEFT JOIN ({SIZES}) d ON p.p_size = cast(substring(d.source, 4) AS int)""",
    "scd_range_join": f"""
        SELECT l.l_orderkey, l.l_linenumber, v.pid, v.ver, v.cost
        FROM {LI} l JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN {PV} v ON l.l_partkey = v.pid AND {VALID}""",
    "scd_as_of_join": f"""
        WITH lines AS (
          SELECT l_orderkey, l_linenumber, l_partkey, cast(o_orderdate AS date) ordered
          FROM {LI} l JOIN orders o ON l.l_orderkey = o.o_orderkey
        ), daily AS (
          SELECT DISTINCT l_partkey part, ordered sd, CASE WHEN l_partkey % 10 <> 0 THEN
            CASE WHEN day(ordered) % 2 = 0 THEN cast(ordered + interval 1 day AS date) ELSE ordered END END ed
          FROM lines
        )
        SELECT l.*, sd, ed FROM lines l LEFT JOIN daily v
          ON part = l_partkey AND ordered BETWEEN sd AND coalesce(ed, date '2002-01-01')""",
    "version_overlap": f"""
        WITH t AS (SELECT pid, ver, sd, CASE WHEN ver = 1 AND p_size < 20
          THEN timestamp '1997-05-30 00:00:00' ELSE ed END ed FROM {PV} z)
        SELECT b.pid p_partkey, b.ver, b.sd, max(coalesce(a.ed, timestamp '2002-01-01 00:00:00')) earlier_end
        FROM t a JOIN t b ON a.pid = b.pid AND a.ver < b.ver
        GROUP BY b.pid, b.ver, b.sd
        HAVING b.sd <= max(coalesce(a.ed, timestamp '2002-01-01 00:00:00'))""",
    "fact_sales": FACT,
    "fact_lookups": f"""
        SELECT l.l_orderkey, l.l_linenumber, p.p_partkey, pr.k promo, te.tk terr, te.rn rname, cu.k curr
        FROM {LI} l JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN part p ON l.l_partkey = p.p_partkey
        LEFT JOIN (SELECT l_discount d, row_number() OVER (ORDER BY l_discount) k
          FROM (SELECT DISTINCT l_discount FROM lineitem) z) pr ON l.l_discount = pr.d
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT n_nationkey, n_regionkey, r_name rn, row_number() OVER (ORDER BY n_nationkey) tk
          FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) te ON c.c_nationkey = te.n_nationkey
        LEFT JOIN (SELECT n_regionkey rk, min(n_nationkey) nk FROM nation GROUP BY 1) rc
          ON te.n_regionkey = rc.rk
        LEFT JOIN (SELECT n_nationkey ck, row_number() OVER (ORDER BY n_nationkey) k FROM nation) cu
          ON rc.nk = cu.ck""",
    "fact_sales_reason": f"""
        SELECT f.son, f.ln, r.rk FROM ({FACT}) f
        JOIN (SELECT o_orderkey, cast(substring(o_orderpriority, 1, 1) AS int) rk
          FROM orders WHERE o_orderpriority < '4') r
          ON r.o_orderkey = cast(substring(f.son, 3) AS bigint)""",
}
