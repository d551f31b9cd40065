"""Text queries: completion, lineage, tags, anagrams, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import textjobs as tj
from millrace.plans.registry import query
from millrace.sources.tables import load, spread

_TERMS = """SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part
            UNION SELECT DISTINCT lower(c_mktsegment) FROM customer"""
# What somebody types: a word cut short, and one with a wrong letter inside.
_TOKENS = f"""SELECT DISTINCT unnest([term[1:3], term[1:2] || 'x' || term[-2:], term]) AS token FROM ({_TERMS})"""


def _side(prefix: str, tokens: str, terms: str) -> str:
    return f"""{prefix}_len AS (SELECT token, max(n) AS n FROM (
          SELECT token, n FROM {tokens}, (SELECT unnest(range(1, 40)) AS n) WHERE n <= length(token)
            AND EXISTS (SELECT 1 FROM {terms} WHERE term[1:n] = token[1:n])) GROUP BY token),
        {prefix} AS (SELECT l.token, t.term FROM {prefix}_len l JOIN {terms} t ON t.term[1:l.n] = l.token[1:l.n] AND length(t.term) > l.n
          WHERE NOT EXISTS (SELECT 1 FROM {terms} o WHERE o.term <> t.term AND starts_with(o.term, t.term)))"""


@query(
    "term_completion",
    f"""WITH terms AS ({_TERMS}), tokens AS ({_TOKENS}),
        rterms AS (SELECT reverse(term) AS term FROM terms), rtokens AS (SELECT reverse(token) AS token FROM tokens),
        {_side("front", "tokens", "terms")}, {_side("back", "rtokens", "rterms")}
        SELECT f.token, f.term, CASE WHEN b.token IS NULL THEN 'front' ELSE 'both' END AS kind
        FROM front f LEFT JOIN (SELECT reverse(token) AS token, reverse(term) AS term FROM back) b
          ON f.token = b.token AND f.term = b.term""",
)
def term_completion(spark, sf):
    words = tj.words(load(spark, sf, "part"), "p_name").select(F.col("word").alias("term"))
    segments = load(spark, sf, "customer").select(F.lower("c_mktsegment").alias("term"))
    terms = words.unionByName(segments).distinct()
    term = F.col("term")
    typed = F.array(
        F.substring(term, 1, 3), F.concat(F.substring(term, 1, 2), F.lit("x"), F.substring(term, -2, 2)), term
    )
    tokens = terms.select(F.explode(typed).alias("token"))
    return tj.complete_terms(tokens, terms)


# One logged statement per order; the order key picks the shape.
_LOG_TEXTS = [
    "select * from orders o join lineitem l on o.o_orderkey = l.l_orderkey where o.o_orderkey = {k}",
    "insert into part select * from supplier, nation where s_name = 'from region' and s_suppkey = {k}",
    "create view big_{m} as select * from customer where c_custkey in (select user_id from events) -- from labels",
    "with recent as (select * from documents where doc_id > {k}), few as (select 1 from recent) select * from few join pages p on true",
    "select extract(year from o_orderdate) from Orders",
    "select * from orders a join customer b on a.o_custkey is distinct from b.c_custkey where trim(both 'x' from c_name) = '{k}'",
    "select * from (select 1 from region) x, nation tablesample (10 percent) n, `part` p where x.r = {k}",
    "with recursive q as (select * from supplier), z(n) as (select 1 from q) delete from labels where doc_id in (select n from z)",
    'create table kept_{m} as select * from "pages" where page_id = {k}',
    "merge into customer using (select * from events) e on c_custkey = e.user_id when matched then update set c_name = '{k}'",
]
# Expected (table, role) pairs per shape, written by hand.
_LOG_TABLES = """(0, 'orders', 'read'), (0, 'lineitem', 'read'), (1, 'part', 'write'), (1, 'supplier', 'read'),
    (1, 'nation', 'read'), (2, 'big_', 'view'), (2, 'customer', 'read'), (2, 'events', 'read'),
    (3, 'documents', 'read'), (3, 'pages', 'read'), (4, 'orders', 'read'), (5, 'orders', 'read'), (5, 'customer', 'read'),
    (6, 'region', 'read'), (6, 'nation', 'read'), (6, 'part', 'read'), (7, 'supplier', 'read'), (7, 'labels', 'write'),
    (8, 'kept_', 'write'), (8, 'pages', 'read'), (9, 'customer', 'write'), (9, 'events', 'read')"""


def _query_log(spark, sf):
    key = F.col("o_orderkey").cast("string")
    shapes = [
        F.replace(F.replace(F.lit(t), F.lit("{k}"), key), F.lit("{m}"), (F.col("o_orderkey") % 7).cast("string"))
        for t in _LOG_TEXTS
    ]
    shape = (F.col("o_orderkey") % len(shapes) + 1).cast("int")
    return spread(load(spark, sf, "orders").select("o_orderkey")).select(
        F.col("o_orderkey").alias("query_id"), F.element_at(F.array(*shapes), shape).alias("sql")
    )


@query(
    "querylog_lineage",
    f"""SELECT o_orderkey AS query_id, CASE WHEN t IN ('big_', 'kept_') THEN t || (o_orderkey % 7) ELSE t END AS "table", role
        FROM orders JOIN (VALUES {_LOG_TABLES}) AS e(shape, t, role) ON o_orderkey % 10 = shape""",
)
def querylog_lineage(spark, sf):
    return tj.query_tables(_query_log(spark, sf), "query_id", "sql")


# Parts of page addresses and the kind of page they tell.
_URL_KINDS = {"blog.": "Blog", "spam-farm": "Spam", "utm_source": "Feed", "page": "List"}
_KIND_CASES = " ".join(
    f"WHEN contains(url, '{part}') THEN struct_pack(part := '{part}', role := '{role}')"
    for part, role in sorted(_URL_KINDS.items(), key=lambda kv: -len(kv[0]))
)


@query(
    "tag_by_dictionary",
    f"""SELECT page_id, coalesce(k.role, 'unknow') AS role,
              CASE WHEN k IS NULL THEN 'unknow' ELSE substr(url, strpos(url, k.part), length(url) - 3 - strpos(url, k.part)) END AS node
        FROM (SELECT page_id, url, CASE {_KIND_CASES} END AS k FROM pages)""",
)
def tag_by_dictionary(spark, sf):
    role, node = tj.tag_log_file(F.col("url"), _URL_KINDS)
    return load(spark, sf, "pages").select("page_id", role.alias("role"), node.alias("node"))


@query(
    "tag_by_table",
    """SELECT event_id, coalesce(role, 'other') AS role FROM events LEFT JOIN
         (SELECT DISTINCT o_custkey AS user_id, 'buyer' AS role FROM orders) USING (user_id)""",
)
def tag_by_table(spark, sf):
    buyers = (
        load(spark, sf, "orders")
        .select(F.col("o_custkey").alias("user_id"))
        .distinct()
        .withColumn("role", F.lit("buyer"))
    )
    events = load(spark, sf, "events").select("event_id", "user_id")
    return tj.tag_by_table(events, buyers, "user_id", "other").select("event_id", "role")


_WORDS = r"""(SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[\t\n\v\f\r ]+')) AS word FROM documents)
              WHERE word <> '' GROUP BY word)"""


@query(
    "anagram_groups",
    f"""SELECT array_to_string(list_sort(string_split(word, '')), '') AS letters, count(*) AS words, CAST(sum(n) AS BIGINT) AS occurrences,
              min(word) AS first_word, max(word) AS last_word FROM {_WORDS} GROUP BY 1 HAVING count(*) > 1""",
)
def anagram_groups(spark, sf):
    counts = tj.word_count(spread(load(spark, sf, "documents").select("text")), "text")
    return tj.anagram_groups(counts, "word", "n")


@query(
    "text_flags",
    """SELECT p_partkey, word, reverse(word) = word AS palindrome, contains(word || word, reverse(word)) AS rotation
       FROM (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type || ' ' || p_partkey, ' ')) AS word FROM part)""",
)
def text_flags(spark, sf):
    """Flags of every token of the name, the type and the number: does it read
    the same backwards, do its letters, turned round, begin elsewhere in it."""
    tokens = F.explode(F.split(F.concat_ws(" ", "p_name", "p_type", F.col("p_partkey").cast("string")), " "))
    words = load(spark, sf, "part").select("p_partkey", tokens.alias("word"))
    return words.select(
        "p_partkey",
        "word",
        tj.is_palindrome(F.col("word")).alias("palindrome"),
        tj.is_rotation(F.col("word"), F.reverse("word")).alias("rotation"),
    )
