"""Registered queries of this package: each operator over its whole table, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, chat, decontaminate, exact, language, licenses, packing, pieces, prefixes, simhash
from tidemark.llm import substrings, toxicity, webtext
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return keep


def language_model(spark: SparkSession, sf: str) -> dict[str, bytes]:
    """Dictionaries from the labelled documents that are not held out."""
    labelled = table(spark, sf, "documents").filter(~language.held_out())
    return language.learn(labelled)


#: DuckDB: words of a column as in the contamination contract.
_WORDS = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


#: DuckDB: a text as the template writes it.
_CODED = "replace(replace(replace({0}, chr(92), chr(92) || 'b'), '#', chr(92) || 'h'), '<', chr(92) || 'l')"

#: The conversation that holds the template's own control strings.
_CONTROL = r"\### Assistant: </turn> ok"


@query(
    rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{_CONTROL}'),
t AS (
  SELECT *, row_number() OVER c AS pos,
    len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\x09-\x0D ]')) + {chat.MARKS} AS n,
    length('### : ' || ' </turn>' || chr(10))
      + length(replace({_CODED.format("role")}, ':', chr(92) || 'c')) + length({_CODED.format("text")}) AS size
  FROM given WINDOW c AS (PARTITION BY conv_id ORDER BY turn, role, text)),
o AS (
  SELECT conv_id, role = 'system' AS sys, CASE WHEN role = 'system' THEN n ELSE 0 END AS sys_n,
    CASE WHEN role = 'system' THEN size ELSE 0 END AS sys_size,
    greatest({chat.BUDGET - chat.HISTORY} - CASE WHEN role = 'system' THEN n ELSE 0 END, {2 * chat.MARKS}) // 2 AS stride
  FROM t WHERE pos = 1),
p AS (
  SELECT t.*, sum(n) OVER (PARTITION BY t.conv_id ORDER BY pos) - n - sys_n AS start, sys, stride, sys_size
  FROM t JOIN o USING (conv_id)),
w AS (
  SELECT *, CAST(floor(start / stride) AS BIGINT) * 2 + CAST(n > stride AS BIGINT) AS win
  FROM p WHERE NOT (sys AND pos = 1)),
edge AS (
  SELECT conv_id, win, lead(min(start)) OVER (PARTITION BY conv_id ORDER BY win) AS next_start
  FROM w GROUP BY conv_id, win),
chars AS (
  SELECT conv_id, sum(size) + sum(CASE WHEN next_start - start <= {chat.HISTORY} THEN size ELSE 0 END) AS c
  FROM w JOIN edge USING (conv_id, win) GROUP BY conv_id),
heads AS (
  SELECT o.conv_id, sys_size * greatest(count(edge.win), 1) AS c
  FROM o LEFT JOIN edge USING (conv_id) GROUP BY o.conv_id, sys_size)
SELECT t.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(any_value(chars.c), 0) + any_value(heads.c) AS BIGINT) AS formatted_chars
FROM t LEFT JOIN chars USING (conv_id) JOIN heads USING (conv_id) GROUP BY t.conv_id
"""
)
def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of what the formatted windows hold, parsed from the windows.

    The contract's digests are over whole conversations, so one row here holds
    one conversation; the windows themselves are bounded.
    """
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast(given.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(given.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CONTROL).alias("text"),
    )
    back = chat.read_back(chat.format_windows(given.unionByName(control)))
    joined = lambda arrays: F.array_join(arrays, "")
    lines = F.transform("new_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    whole = back.groupBy("conv_id").agg(
        F.sum(F.size("new_turns")).alias("n_turns"),
        F.sort_array(
            F.collect_list(
                F.struct("window", joined(lines).alias("turns"), joined("targets").alias("loss"))
            )
        ).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = joined(F.transform("w", lambda x: x["turns"]))
    loss = joined(F.transform("w", lambda x: x["loss"]))
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


@query()
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    chain = toxicity.learn_chain(docs, table(spark, sf, "labels"))
    return toxicity.score_toxicity(docs, chain)


_NOTICES = ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items()
)


@query(
    f"""
WITH notice(license, text) AS (VALUES {_NOTICES}),
tw AS (SELECT license, {_WORDS.format("text")} AS w FROM notice),
ts AS (
  SELECT DISTINCT license, array_to_string(w[s : s + {licenses.SHINGLE - 1}], ' ') AS g
  FROM (SELECT license, w, unnest(range(1, greatest(len(w) - {licenses.SHINGLE - 1}, 1) + 1)) AS s FROM tw)),
size AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
dw AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + {licenses.SHINGLE - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {licenses.SHINGLE - 1}, 1) + 1)) AS s
        FROM dw WHERE len(w) > 0)),
held AS (
  SELECT doc_id, license FROM ds JOIN ts USING (g) JOIN size USING (license)
  GROUP BY doc_id, license, n HAVING count(*) >= {licenses.CONTAINMENT} * n)
SELECT d.doc_id, count(license) AS n_licenses,
  coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses
FROM documents d LEFT JOIN held USING (doc_id) GROUP BY d.doc_id
"""
)
def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"), language_model(spark, sf))


@query()
def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query(
    """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (
  SELECT doc_id, s, substr(x, 2 * s + 1, 100) AS g
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS s FROM d)),
h AS (
  SELECT doc_id, s FROM p JOIN (SELECT g, min(doc_id) AS f FROM p GROUP BY g) USING (g)
  WHERE doc_id > f),
e AS (SELECT doc_id, s, CAST(s - coalesce(lag(s) OVER w, -99) > 50 AS INT) AS new FROM h
      WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
r AS (
  SELECT doc_id, min(s) AS b, max(s) + 50 AS e
  FROM (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM e)
  GROUP BY doc_id, k),
t AS (SELECT doc_id, sum(e - b) AS n, count(*) AS k FROM r GROUP BY doc_id),
keep AS (
  SELECT doc_id, b, lead(b) OVER (PARTITION BY doc_id ORDER BY b, e) AS nb, e
  FROM (SELECT doc_id, 0 AS b, 0 AS e FROM d UNION ALL SELECT doc_id, b, e FROM r)),
kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * e + 1, 2 * (coalesce(nb, length(x) // 2) - e)), ''
    ORDER BY b, e) AS y
  FROM keep JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(t.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(t.k, 0) AS BIGINT) AS n_spans,
  sha256(unhex(y)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) JOIN kept USING (doc_id)
"""
)
def op6_repeated_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.find_repeats(table(spark, sf, "documents")).drop("spans")


@query(
    f"""
WITH dw AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
sized AS (SELECT DISTINCT item_id, w, least(13, len(w)) AS k FROM iw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM sized)),
ks AS (SELECT DISTINCT k FROM win),
dg AS (
  SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM dw CROSS JOIN ks WHERE len(w) >= k)),
occ AS (SELECT doc_id, dg.k, s, item_id FROM dg JOIN win ON dg.k = win.k AND dg.g = win.g),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, k, s FROM occ))
  GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
)
def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    )
    return found.drop("items", "spans")


@query(
    """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
)
def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.duplicate_groups(table(spark, sf, "documents"))


@query()
def op9_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "round_trip",
    )


@query()
def op10_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return webtext.extract_main_text(table(spark, sf, "pages"))


@query()
def op12_pack_documents(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf, "documents"))
    return packed.select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op11_align_tokenizers(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf, "documents")).documents


#: DuckDB: the CRC-32 of a number's decimal digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
  string_split(CAST({0} AS VARCHAR), ''), lambda ch: CAST([unicode(ch), -1, -1, -1, -1, -1, -1, -1, -1] AS BIGINT[])))),
  lambda x, v: CASE WHEN v >= 0 THEN xor(x, v) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""


@query(
    f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, c - c % 100 AS base, {_CRC32.format("c")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
size AS (SELECT c, count(*) AS n FROM t GROUP BY c),
r AS (
  SELECT k.c, p AS d, role, text FROM k JOIN t ON t.c = base AND p <= h
  UNION ALL
  SELECT k.c, p - h + least(h, coalesce(size.n, 0)), role, text
  FROM k JOIN t USING (c) LEFT JOIN size ON size.c = base WHERE p > h),
m AS (
  SELECT c, d, length(text) AS n, md5(string_agg(
    concat(length(role), ':', length(text), ':', role, text), '') OVER (PARTITION BY c ORDER BY d)) AS key
  FROM r UNION ALL SELECT c, 0, 0, '' FROM k),
node AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM m GROUP BY key, d),
edge AS (SELECT DISTINCT m.key, up.key AS parent FROM m JOIN m up ON m.c = up.c AND up.d = m.d - 1),
kids AS (SELECT parent AS key, count(*) AS n_children FROM edge GROUP BY parent),
under AS (SELECT DISTINCT m.key, low.key AS lower FROM m JOIN m low ON m.c = low.c AND low.d >= m.d),
sums AS (
  SELECT under.key, count(*) FILTER (n_children IS NULL) AS n_leaves,
    sum((n_convs - 1) * n) AS saved_tokens
  FROM under JOIN node ON node.key = lower LEFT JOIN kids ON kids.key = lower GROUP BY under.key),
ends AS (
  SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, max_by(key, d) AS key FROM m GROUP BY c) GROUP BY key)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sums USING (key) LEFT JOIN kids USING (key) LEFT JOIN ends USING (key)
LEFT JOIN edge USING (key) LEFT JOIN node up ON up.key = edge.parent
"""
)
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf, "conversations"))
