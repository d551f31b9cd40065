"""Text jobs: word counts, term completion, query-log lineage, log tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.session import written

# Part of a log file name -> role of the process that writes it.
LOG_ROLES = {
    "taskexecutor": "TaskManager",
    "zookeeper": "FlinkZooKeeperQuorumPeer",
    "historyserver": "HistoryServer",
    "standalonesession": "JobManager",
    "standalonejob": "JobManager",
    "kubernetes-session": "JobManager",
    "kubernetes-application": "JobManager",
    "kubernetes-taskmanager": "TaskManager",
}
# Fixed value: role and node id of a file name with no known part.
UNKNOWN_ROLE = "unknow"


def words(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per whitespace-separated word."""
    tokens = F.explode(F.split(F.col(text), r"\s+"))
    return df.select(*keep, tokens.alias("word")).where("word <> ''")


def word_count(df: DataFrame, text: str) -> DataFrame:
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def anagram_groups(word_counts: DataFrame, word: str, n: str) -> DataFrame:
    """Letters shared by two or more different words, from counted words."""
    letters = F.concat_ws("", F.array_sort(F.split(F.col(word), "")))
    return (
        word_counts.groupBy(letters.alias("letters"))
        .agg(
            F.count(F.lit(1)).alias("words"),
            F.sum(n).alias("occurrences"),
            F.min(word).alias("first_word"),
            F.max(word).alias("last_word"),
        )
        .where("words > 1")
    )


def is_palindrome(text: Column) -> Column:
    return F.reverse(text) == text


def is_rotation(left: Column, right: Column) -> Column:
    """``right`` is ``left`` with some letters moved from the front to the end."""
    return (F.length(left) == F.length(right)) & F.contains(F.concat(left, left), right)


def _prefixes(df: DataFrame, text: str) -> DataFrame:
    size = F.explode(F.sequence(F.lit(1), F.length(text))).alias("__len")
    return df.where(F.length(text) > 0).select("*", size).withColumn(
        "__prefix", F.substring(F.col(text), F.lit(1), F.col("__len"))
    )


def _completions(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """token -> terms that continue the longest prefix some term has in common."""
    by_prefix = written(terms.sparkSession, _prefixes(terms, "term"), "prefixes")
    known = by_prefix.select("__prefix").distinct()
    # a term that begins another term is passed through, never offered
    inner = by_prefix.where(F.col("__len") < F.length("term")).select(F.col("__prefix").alias("term")).distinct()
    offered = by_prefix.join(inner, "term", "left_anti").where(F.length("term") > F.col("__len"))
    longest = (
        _prefixes(tokens, "token")
        .join(known, "__prefix", "left_semi")
        .groupBy("token")
        .agg(F.max("__len").alias("__len"))
        .withColumn("__prefix", F.substring(F.col("token"), F.lit(1), F.col("__len")))
    )
    return longest.join(offered.select("__prefix", "term"), "__prefix").select("token", "term")


def complete_terms(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """Fuzzy completion of each ``token`` from the dictionary ``term``.

    Letters are followed from the front, and from the back on the reversed
    words, as far as any term agrees. Terms found both ways come first
    (``kind`` ``both``), then those found from the front only (``front``);
    from the back alone a term is not offered, nor is one with nothing to add.
    """
    spark = terms.sparkSession
    tokens = written(spark, tokens.select("token").distinct(), "tokens")
    terms = written(spark, terms.select("term").distinct(), "terms")
    turn = lambda df, c: df.select(F.reverse(c).alias(c))
    front = _completions(tokens, terms)
    back = _completions(turn(tokens, "token"), turn(terms, "term")).select(
        F.reverse("token").alias("token"), F.reverse("term").alias("term"), F.lit(True).alias("__back")
    )
    kind = F.when(F.col("__back"), F.lit("both")).otherwise(F.lit("front"))
    return front.join(back, ["token", "term"], "left").select("token", "term", kind.alias("kind"))


# Names are matched in lower-cased text from which literals, comments and quotes
# are gone. Parentheses are taken out from the inside: a subquery leaves _SUB in
# its place, anything else _ARGS.
_SUB, _ARGS = "__sub", "__args"
_NAME = rf"(?!{_SUB}\b|{_ARGS}\b)[a-z_][\w$]*(?:\s*\.\s*[a-z_0-9][\w$]*)*"
_END = (
    "as|join|inner|left|right|full|cross|natural|lateral|on|using|where|group|having|order|limit|"
    "union|intersect|except|minus|window|tablesample|set|when|values|select|sort|cluster|distribute|pivot|unpivot|semi|anti"
)
# one table of a FROM list: a name or a subquery, perhaps sampled, perhaps with an alias
_SAMPLE = rf"(?:\s+tablesample\s+{_ARGS}(?:\s+repeatable\s+{_ARGS})?)?"
_ALIAS = rf"(?:\s+(?:as\s+)?(?!(?:{_END})\b)[a-z_]\w*(?:\s+{_ARGS})?)?"
_ITEM = rf"(?:lateral\s+)?(?:{_NAME}(?:\s+{_ARGS})?|{_SUB}|{_ARGS}){_SAMPLE}{_ALIAS}{_SAMPLE}"
_WRITE = (
    r"insert\s+(?:into|overwrite)(?:\s+table)?|delete\s+from|merge\s+into|update"
    r"|create\s+(?:or\s+replace\s+)?(?:temporary\s+|temp\s+|external\s+)?table(?:\s+if\s+not\s+exists)?"
)
_VIEW = r"view(?:\s+if\s+not\s+exists)?"
_HIT = rf"\b(?:{_WRITE}|{_VIEW})\s+(?!set\b){_NAME}|\b(?:from|join|using)\s+{_ITEM}(?:\s*,\s*{_ITEM})*"
_CTE = rf"(?:\bwith(?:\s+recursive)?|,)\s*({_NAME})(?:\s+{_ARGS})?\s+as(?:\s+(?:not\s+)?materialized)?\s+{_SUB}"
_NOISE = r"'(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*[\s\S]*?\*/"
_INNER = r"\(([^()]*)\)"


def _statements(sql: Column) -> Column:
    """The text and its subqueries, none of them with parentheses."""
    plain = F.regexp_replace(F.lower(sql), _NOISE, " ")
    plain = F.regexp_replace(plain, r'[`"]', "")
    plain = F.regexp_replace(plain, r"\bis\s+(?:not\s+)?distinct\s+from\b", " = ")
    is_query = r"^\s*(?:select|with|from|values|insert)\b"

    def step(acc: Column, _: Column) -> Column:
        inner = F.regexp_extract_all(acc["text"], F.lit(_INNER), F.lit(1))
        # a group of joined tables is read like a FROM list
        joined = F.transform(inner, lambda t: F.when(t.rlike(r"\bjoin\b") & ~t.rlike(is_query), F.concat(F.lit("from "), t)).otherwise(t))
        text = F.regexp_replace(acc["text"], rf"\((\s*{_SUB}\s*|(?=\s*(?:select|with|from|values)\b)[^()]*|[^()]*\bjoin\b[^()]*)\)", f" {_SUB} ")
        return F.struct(
            F.regexp_replace(text, _INNER, f" {_ARGS} ").alias("text"),
            F.concat(acc["found"], F.filter(joined, lambda t: t.rlike(is_query))).alias("found"),
        )

    # as many steps as there are parentheses, and so at least as many as they are deep
    deep = F.length(plain) - F.length(F.replace(plain, F.lit("("), F.lit("")))
    return F.aggregate(
        F.when(deep > 0, F.sequence(F.lit(1), deep)).otherwise(F.array().cast("array<int>")),
        F.struct(plain.alias("text"), F.array().cast("array<string>").alias("found")),
        step,
        lambda acc: F.concat(F.array(acc["text"]), acc["found"]),
    )


def query_tables(log: DataFrame, query_id: str, text: str) -> DataFrame:
    """Tables each logged SQL text names: ``query_id``, ``table``, ``role``.

    Roles are ``read`` (FROM, JOIN, USING of a merge, at any depth), ``write``
    (insert, update, delete, merge, create table) and ``view`` (the view
    created). Names of WITH bodies, functions, literals and comments do not
    count; quotes around names are dropped.
    """
    parts = log.select(query_id, _statements(F.col(text)).alias("__parts"))
    # once per text, not once per hit
    bodies = parts.withColumn(
        "__cte", F.flatten(F.transform("__parts", lambda p: F.regexp_extract_all(p, F.lit(_CTE), F.lit(1))))
    )
    hits = bodies.select(query_id, "__cte", F.explode("__parts").alias("__part")).select(
        query_id, "__cte", F.explode(F.regexp_extract_all("__part", F.lit(_HIT), F.lit(0))).alias("__hit")
    )
    reads = F.col("__hit").rlike(r"^(?:from|join|using)\b")
    role = F.when(F.col("__hit").rlike(r"^view\b"), "view").when(reads, "read").otherwise("write")
    names = F.when(reads, F.split(F.regexp_replace("__hit", r"^(?:from|join|using)\s+", ""), r"\s*,\s*")).otherwise(
        F.array(F.regexp_replace("__hit", rf"^(?:{_WRITE}|{_VIEW})\s+", ""))
    )
    return (
        hits.select(query_id, "__cte", role.alias("role"), F.explode(names).alias("__item"))
        # a name before arguments is a function
        .where(~F.col("__item").rlike(rf"^(?:lateral\s+)?{_NAME}\s+{_ARGS}") | (F.col("role") != "read"))
        .withColumn("table", F.regexp_replace(F.regexp_extract("__item", rf"^(?:lateral\s+)?({_NAME})", 1), r"\s+", ""))
        # coalesce: else the planner tests the regular expressions for null a second time
        .where((F.col("table") != "") & ~F.coalesce(F.array_contains("__cte", F.col("table")), F.lit(False)))
        .select(query_id, "table", "role")
        .distinct()
    )


def tag_log_file(file_name: Column, roles: dict[str, str] | None = None) -> tuple[Column, Column]:
    """Role and node id of a log file name.

    The node id runs from the part found to four characters before the end
    (the extension). If several parts occur the longest decides.
    """
    roles = LOG_ROLES if roles is None else roles
    role, node = F.lit(UNKNOWN_ROLE), F.lit(UNKNOWN_ROLE)
    for part in sorted(roles, key=len):
        start = F.locate(part, file_name)
        role = F.when(start > 0, F.lit(roles[part])).otherwise(role)
        node = F.when(start > 0, F.substring(file_name, start, F.length(file_name) - 3 - start)).otherwise(node)
    return role, node


def tag_by_table(df: DataFrame, dictionary: DataFrame, on: str, default: str) -> DataFrame:
    """Tag rows from a dictionary table with the columns ``on`` and ``role``."""
    return lookup_join(df, dictionary, [on]).withColumn("role", F.coalesce("role", F.lit(default)))
