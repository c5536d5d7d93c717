"""B, H and J: projections, filters, rules and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.text import (
    category_path,
    extract_or_null,
    first_of,
    format_size,
    title_case,
)
from tallybook.operators.rules import apply_rules, resolve_name, with_rules
from tallybook.sources.partitions import since_year_start
from workload.mart import title
from workload.registry import query
from workload.tables import budget, table, tx, with_


@query(
    "b1_struct_projection",
    """
SELECT c_custkey, c_acctbal AS current_balance, 'USD' AS currency_code, c_mktsegment AS segment
FROM customer""",
)
def struct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_acctbal").alias("current"),
            F.lit("USD").alias("currency_code"),
            F.struct(F.col("c_mktsegment").alias("segment")).alias("owner"),
        ).alias("balance"),
    )
    return nested.select(
        "c_custkey",
        F.col("balance.current").alias("current_balance"),
        "balance.currency_code",
        "balance.owner.segment",
    )


@query(
    "b2_star_except",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def star_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return spark.sql("SELECT * EXCEPT (o_orderstatus, o_orderdate) FROM {o}", o=orders)


@query(
    "b3_label_case",
    """
SELECT c_custkey,
  CASE WHEN n_name = 'NATION_1' THEN 'One' WHEN n_name = 'NATION_2' THEN 'Two'
       WHEN c_mktsegment = 'MACHINERY' THEN 'Machines' ELSE n_name END AS label,
  CASE WHEN n_name = 'NATION_1' THEN CASE WHEN c_name LIKE '%7' THEN 'seven' ELSE c_name END
       WHEN n_name IN ('NATION_3', 'NATION_4', 'NATION_5') THEN lower(c_mktsegment)
       WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE n_name END AS sublabel
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def label_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    one = {"col": "n_name", "op": "eq", "value": "NATION_1"}
    machines = {"col": "c_mktsegment", "op": "eq", "value": "MACHINERY"}
    label = [
        {"when": one, "then": "One"},
        {"when": {"col": "n_name", "op": "eq", "value": "NATION_2"}, "then": "Two"},
        {"when": machines, "then": "Machines"},
    ]
    sublabel = [
        {"when": {"all": [one, {"col": "c_name", "op": "like", "value": "%7"}]}, "then": "seven"},
        {"when": one, "then": {"col": "c_name"}},
        {
            "when": {"col": "n_name", "op": "in", "value": ["NATION_3", "NATION_4", "NATION_5"]},
            "then": {"col": "segment_lower"},
        },
        {"when": machines, "then": {"col": "c_name"}},
    ]
    extra = {"segment_lower": F.lower("c_mktsegment")}
    return joined.select(
        "c_custkey",
        apply_rules(label, F.col("n_name")).alias("label"),
        apply_rules(sublabel, F.col("n_name"), extra).alias("sublabel"),
    )


@query(
    "b4_sign_type",
    with_(
        "tx",
        """
SELECT transaction_id, CASE WHEN amount > 0 THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
       amount * -1 AS actual_amount,
       CASE WHEN status = 'O' THEN amount * -1 ELSE amount END AS flipped
FROM tx""",
    ),
)
def sign_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("amount")
    return tx(spark, sf_dir).select(
        "transaction_id",
        F.when(amount > 0, "DEBIT").otherwise("CREDIT").alias("transaction_type"),
        (amount * -1).alias("actual_amount"),
        F.when(F.col("status") == "O", amount * -1).otherwise(amount).alias("flipped"),
    )


def _is(col: str, op: str, value, **more) -> dict:
    return {"col": col, "op": op, "value": value, **more}


@query(
    "b5_rule_category",
    """
SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN 'three' WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap'
    WHEN lower(p_type) = 'large' THEN 'big' ELSE p_type END AS category
FROM part""",
)
def rule_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality: with one value, with several, and in any case."""
    rules = [
        {"when": _is("p_brand", "eq", "Brand#3"), "then": "three"},
        {"when": _is("p_type", "in", ["ECONOMY", "PROMO"]), "then": "cheap"},
        {"when": _is("p_type", "eq", "large", fold=True), "then": "big"},
    ]
    return table(spark, sf_dir, "part").select("p_partkey", apply_rules(rules, F.col("p_type")).alias("category"))


@query(
    "b5_rule_text",
    """
SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') THEN 'starts' WHEN p_name LIKE '%hot w%' THEN 'holds'
    WHEN regexp_matches(p_name, 'e.r') THEN 'matches' END AS found
FROM part""",
)
def rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beginning, pattern and regular expression; no default."""
    rules = [
        {"when": _is("p_name", "startswith", "red"), "then": "starts"},
        {"when": _is("p_name", "like", "%hot w%"), "then": "holds"},
        {"when": _is("p_name", "regex", "e.r"), "then": "matches"},
    ]
    return table(spark, sf_dir, "part").select("p_partkey", apply_rules(rules, F.lit(None)).alias("found"))


@query(
    "b5_rule_extract",
    r"""
SELECT p_partkey, CASE WHEN regexp_extract(p_name, '^(\w+)', 1) = 'old' THEN 'old'
    WHEN regexp_matches(p_name, '(\w+)$') THEN regexp_extract(p_name, '(\w+)$', 1) END AS word
FROM part""",
)
def rule_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part of the text, as condition and as value."""
    rules = [
        {"when": _is("p_name", "extract_eq", [r"^(\w+)", "old"]), "then": "old"},
        {"when": _is("p_name", "present", True), "then": {"col": "p_name", "extract": r"(\w+)$"}},
    ]
    return table(spark, sf_dir, "part").select("p_partkey", apply_rules(rules, F.lit(None)).alias("word"))


_MANY = 1000


@query(
    "b5_many_rules",
    f"""
SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN 'dear' WHEN o_custkey < {_MANY} THEN 'customer ' || o_custkey
    WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE o_orderpriority END AS category
FROM orders""",
)
def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list with a rule for each of a thousand customers, and others before and after them."""
    rules = [{"when": _is("o_totalprice", "gt", 450000), "then": "dear"}]
    rules += [{"when": _is("customer", "eq", str(k)), "then": f"customer {k}"} for k in range(_MANY)]
    rules += [{"when": _is("o_orderpriority", "eq", "5-LOW"), "then": "low"}]
    orders = table(spark, sf_dir, "orders").withColumn("customer", F.col("o_custkey").cast("string"))
    found = with_rules(orders, rules, F.col("o_orderpriority"), "category")
    return found.select("o_orderkey", "category")


@query(
    "b5_many_prefixes",
    f"""
SELECT doc_id, CASE WHEN n_chars < 60 THEN -1
    WHEN length(t) >= 3 AND c < 500 AND substr(t, 1, 1) = 'T' THEN c
    WHEN starts_with(t, 'The') THEN {_MANY} WHEN contains(t, '://') THEN {_MANY + 1} END AS label
FROM (SELECT doc_id, n_chars, text AS t, (ascii(substr(text, 2, 1)) * 31 + ascii(substr(text, 3, 1))) % 1000 AS c,
             ascii(substr(text, 2, 1)) BETWEEN 97 AND 122 AND ascii(substr(text, 3, 1)) BETWEEN 97 AND 122 AS plain
      FROM documents) WHERE plain""",
)
def many_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for hundreds of beginnings of a text, of two lengths, with numbers as values."""
    rules = [{"when": _is("n_chars", "lt", 60), "then": -1}]
    for a in range(97, 123):
        for b in range(97, 123):
            if (c := (a * 31 + b) % 1000) < 500:
                start = f"T{chr(a)}{chr(b)}"
                rules.append({"when": _is("text", *(("like", start + "%") if b % 2 else ("startswith", start))), "then": c})
    rules.append({"when": _is("text", "startswith", "The"), "then": _MANY})
    rules.append({"when": _is("text", "like", "%://%"), "then": _MANY + 1})
    docs = table(spark, sf_dir, "documents").where(F.substring("text", 2, 2).rlike("^[a-z]{2}$"))
    return with_rules(docs, rules, F.lit(None), "label").select("doc_id", "label")


@query(
    "b6_rule_subcategory",
    """
SELECT p_partkey, CASE WHEN p_size < 10 AND p_type <> 'SMALL' THEN 'few'
    WHEN p_size > 40 OR p_retailprice > 1500 THEN 'much' ELSE p_type END AS subcategory
FROM part""",
)
def rule_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, and conditions that all or any hold."""
    rules = [
        {"when": {"all": [_is("p_size", "lt", 10), _is("p_type", "not_in", ["SMALL"])]}, "then": "few"},
        {"when": {"any": [_is("p_size", "gt", 40), _is("p_retailprice", "gt", 1500)]}, "then": "much"},
    ]
    return table(spark, sf_dir, "part").select("p_partkey", apply_rules(rules, F.col("p_type")).alias("subcategory"))


@query(
    "b6_rule_nulls",
    """
SELECT event_id, CASE WHEN kind NOT IN ('view', 'click') THEN 'other' WHEN kind IS NULL THEN 'none' ELSE kind END AS label
FROM (SELECT event_id, NULLIF(event_type, 'error') AS kind FROM events)""",
)
def rule_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL is in no list and not outside of one; it can be asked for."""
    rules = [
        {"when": _is("kind", "not_in", ["view", "click"]), "then": "other"},
        {"when": _is("kind", "present", False), "then": "none"},
    ]
    rows = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return rows.select("event_id", apply_rules(rules, F.col("kind")).alias("label"))


@query(
    "b7_merchant_resolution",
    r"""
SELECT page_id, COALESCE(
  CASE WHEN starts_with(url, 'https://www.') THEN 'Web site' END,
  CASE WHEN regexp_matches(html, '<html lang="fr"') THEN 'Site ' || page_id END,
  CASE WHEN regexp_matches(url, '//m\.') THEN CASE WHEN regexp_matches(url, '//m\.([^/]+)') THEN regexp_extract(url, '//m\.([^/]+)', 1) END
       WHEN regexp_matches(url, 'ref=') THEN CASE WHEN regexp_matches(url, '\?(.*?)&ref') THEN regexp_extract(url, '\?(.*?)&ref', 1) END
       WHEN regexp_matches(url, '^https?://') THEN regexp_extract(url, '^https?://([^/]+)', 1)
       ELSE url END) AS site
FROM pages""",
)
def merchant_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, html = F.col("url"), F.col("html")
    rules = [
        {"when": _is("url", "regex", r"//m\."), "then": {"col": "url", "extract": r"//m\.([^/]+)"}},
        {"when": _is("url", "regex", "ref="), "then": {"col": "url", "extract": r"\?(.*?)&ref"}},
        {"when": _is("url", "regex", "^https?://"), "then": {"col": "url", "extract": "^https?://([^/]+)"}},
    ]
    clean = F.when(url.startswith("https://www."), "Web site")
    french = html.rlike('<html lang="fr"')
    candidates = F.when(french, F.array(F.concat(F.lit("Site "), "page_id"))).when(
        url.startswith("http://"), F.array().cast("array<string>")
    )
    site = resolve_name(clean, candidates, rules, url)
    return table(spark, sf_dir, "pages").select("page_id", site.alias("site"))


@query(
    "b8_first_element",
    """
SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[10000] AS far_word
FROM documents""",
)
def first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", first_of(words).alias("first_word"), F.get(words, F.lit(9999)).alias("far_word")
    )


@query(
    "b8_first_vector_element",
    """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[10000] AS DOUBLE) AS far_value
FROM embeddings""",
)
def first_vector_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        first_of(v).cast("double").alias("first_value"),
        F.get(v, F.lit(9999)).cast("double").alias("far_value"),
    )


@query(
    "b9_rolling_window_filter",
    with_("tx", "SELECT transaction_id, transaction_date, amount FROM tx WHERE transaction_date >= DATE '1999-01-01'"),
)
def rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tx(spark, sf_dir).select("transaction_id", "transaction_date", "amount")
    return since_year_start(rows, "transaction_date", date(2001, 8, 1))


@query(
    "b10_not_pending",
    with_(
        "tx",
        """
SELECT transaction_id, amount FROM tx WHERE NOT (NULLIF(status, 'O') = 'P')""",
    ),
)
def not_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = F.nullif("status", F.lit("O")) == "P"
    return tx(spark, sf_dir).withColumn("is_pending", pending).where(~F.col("is_pending")).select("transaction_id", "amount")


@query(
    "b11_not_in_3vl",
    """
SELECT event_id, kind FROM (SELECT event_id, NULLIF(event_type, 'error') AS kind FROM events)
WHERE kind NOT IN ('view', 'click') AND kind <> 'signup'""",
)
def not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("kind")
    rows = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return rows.where(~kind.isin("view", "click") & (kind != "signup"))


@query(
    "b12_recode",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' AND c_mktsegment = 'MACHINERY' THEN 'Machines'
    WHEN o_orderpriority = '5-LOW' AND c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'House'
    WHEN o_orderpriority = '5-LOW' THEN 'Other' ELSE o_orderpriority END AS subcategory
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = _is("o_orderpriority", "eq", "5-LOW")
    rules = [
        {"when": {"all": [low, _is("c_mktsegment", "in", ["MACHINERY"])]}, "then": "Machines"},
        {"when": {"all": [low, _is("c_mktsegment", "in", ["BUILDING", "FURNITURE"])]}, "then": "House"},
        {"when": low, "then": "Other"},
    ]
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return joined.select("o_orderkey", apply_rules(rules, F.col("o_orderpriority")).alias("subcategory"))


@query(
    "b13_category_path",
    with_(
        "budget",
        """
SELECT transaction_month, category, subcategory, detail_category,
       category || ' - ' || subcategory AS final_category,
       category || ' - ' || subcategory ||
         CASE WHEN detail_category IS NULL THEN '' ELSE ' - ' || detail_category END AS full_category,
       NULLIF(category, 'Income') || ' - ' || subcategory AS path_or_null
FROM budget""",
    ),
)
def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    top, sub, detail = F.col("category"), F.col("subcategory"), F.col("detail_category")
    return budget(spark, sf_dir).select(
        "transaction_month",
        top,
        sub,
        detail,
        category_path(top, sub).alias("final_category"),
        category_path(top, sub, detail).alias("full_category"),
        category_path(F.nullif(top, F.lit("Income")), sub).alias("path_or_null"),
    )


@query(
    "h1_scalar_functions",
    r"""
SELECT o_orderkey,
  CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed_day,
  CAST(strptime(strftime(o_orderdate, '%Y%m'), '%Y%m') AS DATE) AS parsed_month,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
  CAST(o_orderdate - INTERVAL 2 YEAR AS DATE) AS two_years_back,
  strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%d %H:%M:%S') AS clock,
  regexp_matches(o_orderpriority, '[A-Z]{6}') AS has_long_word,
  CASE WHEN regexp_matches(o_orderpriority, '^(\d)-(H.*)$') THEN regexp_extract(o_orderpriority, '^(\d)-(H.*)$', 2) END AS extracted,
  o_orderpriority LIKE '%LOW%' AS is_low, starts_with(o_orderpriority, '1') AS is_first,
  lower(o_orderpriority) AS lowered, right(o_orderpriority, 3) AS last_three,
  list_extract(string_split(o_orderpriority, '-'), -1) AS last_part,
  rtrim(o_orderpriority, 'TNEGRU') AS trimmed,
  o_orderstatus || ' - ' || NULLIF(o_orderpriority, '5-LOW') AS joined,
  COALESCE(NULLIF(o_orderstatus, 'P'), 'pending') AS defaulted,
  round(o_totalprice / 7, 2) AS seventh, abs(o_totalprice - 200000) AS distance,
  o_totalprice / NULLIF(o_custkey % 3, 0) AS safe_ratio,
  len(string_split(o_orderpriority, 'E')) AS pieces,
  CAST(NULL AS DOUBLE) AS nothing
FROM orders""",
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, p, price = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_totalprice")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").alias("parsed_day"),
        F.to_date(F.date_format(d, "yyyyMM"), "yyyyMM").alias("parsed_month"),
        F.trunc(d, "MM").alias("month_start"),
        F.trunc(d, "YEAR").alias("year_start"),
        F.add_months(d, -24).alias("two_years_back"),
        F.date_format(F.timestamp_add("SECOND", F.col("o_orderkey"), epoch), "yyyy-MM-dd HH:mm:ss").alias("clock"),
        p.rlike("[A-Z]{6}").alias("has_long_word"),
        extract_or_null(p, r"^(\d)-(H.*)$", 2).alias("extracted"),
        p.like("%LOW%").alias("is_low"),
        p.startswith("1").alias("is_first"),
        F.lower(p).alias("lowered"),
        F.substring(p, -3, 3).alias("last_three"),
        F.element_at(F.split(p, "-"), -1).alias("last_part"),
        F.rtrim(p, F.lit("TNEGRU")).alias("trimmed"),
        F.concat("o_orderstatus", F.lit(" - "), F.nullif(p, F.lit("5-LOW"))).alias("joined"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("pending")).alias("defaulted"),
        F.round(price / 7, 2).alias("seventh"),
        F.abs(price - 200000).alias("distance"),
        F.try_divide(price, F.col("o_custkey") % 3).alias("safe_ratio"),
        F.size(F.split(p, "E")).alias("pieces"),
        F.lit(None).cast("double").alias("nothing"),
    )


_TITLE_INPUT = "upper(p_name) || ' AND THE ' || p_type || '  on a ' || lower(p_brand)"


@query("j1_title_case", f"SELECT p_partkey, {title(f'({_TITLE_INPUT})')} AS title FROM part")
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.upper("p_name"), F.lit(" AND THE "), "p_type", F.lit("  on a "), F.lower("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(text).alias("title"))


def size_sql(x: str) -> str:
    def unit(power: int, name: str) -> str:
        scaled = f"CAST(CAST(round({x} / {1024**power}.0, 2) AS DECIMAL(24,2)) AS VARCHAR)"
        return f"regexp_replace({scaled}, '\\.?0+$', '') || ' {name}'"

    return (
        f"CASE WHEN {x} < 1024 THEN {x} || ' B' WHEN {x} < 1048576 THEN {unit(1, 'KB')} "
        f"WHEN {x} < 1073741824 THEN {unit(2, 'MB')} ELSE {unit(3, 'GB')} END"
    )


@query(
    "j2_format_size",
    f"""
SELECT doc_id, {size_sql('n_chars')} AS chars_size, {size_sql('(n_chars * n_chars)')} AS square_size,
       {size_sql('(n_chars * n_chars * 1000)')} AS large_size
FROM documents""",
)
def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        format_size(n).alias("chars_size"),
        format_size(n * n).alias("square_size"),
        format_size(n * n * 1000).alias("large_size"),
    )
