"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import chat, jaccard, mixing, packing, pii, quality, repeats, toxicity, vectors, wordpiece
from timeloom.llm.runtime import Scratch

CAPACITY = 2048


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place. Null and empty texts are a piece of the end id alone; equal rows are packed each; no documents give no rows."""
    scratch = Scratch(spark, "op1")
    pieces = packing.tokenized_pieces(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), CAPACITY, added_tokens=True)
    pieces = scratch.save(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack_best_fit(pieces, "length", CAPACITY, ["doc_id", "piece", "start", "ids_crc32"])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words less those that a smaller doc_id has in a window of 50. Cases as in repeats.remove_repeats."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), Scratch(spark, "op2")).drop("text", "passages")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document. Cases as in mixing.mix_sources."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of every text. Null and empty texts have none; equal rows give equal results; no documents give no rows."""
    found = pii.find_private_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.select("doc_id", "pii_spans", F.filter("pii_spans", lambda s: s["kind"].isin(*pii.BASE_KINDS)).alias("base"))
    counts = [pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"), pii.spans_text(F.col("pii_spans")).alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document. Cases as in quality.judge_quality."""
    judged, _ = quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), Scratch(spark, "op5"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Tools that a conversation's calls are checked against.
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculate": {"expression": ("string", True)},
    "fetch": {"url": ("string", True), "headers": ("object", False)},
}


def with_tool_calls(conversations: DataFrame) -> DataFrame:
    """conversations, all rows of it, with tool calls and results: the given ones have none.

    By a rule on conversation and turn, most assistant messages become calls of
    four kinds (well formed, ill typed, incomplete, of an unknown tool), some with
    a reference to the result of a call two turns later, with a second call under
    an earlier call's identifier or with one that has none; and most user
    messages become results: of the call before, of the call behind, of no call.
    Message and result contents are the given texts, whole.
    """
    h, turn, text = F.pmod(F.col("conv_id") * 7 + F.col("turn") * 3, F.lit(20)), F.col("turn"), F.col("text")

    def name_of(shift: int) -> Column:
        return F.concat(F.lit("c"), (turn + shift).cast("string"))

    def call(ident: Column | None, name: str, **arguments: Column) -> Column:
        body = F.to_json(F.struct(*[c.alias(k) for k, c in arguments.items()])) if arguments else F.lit("{}")
        head = F.to_json(F.struct(*([ident.alias("id")] if ident is not None else []), F.lit(name).alias("name")))
        return F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"arguments":'), body, F.lit("}"))

    first, query = name_of(0), F.substr(text, F.lit(1), F.lit(12))
    later = F.struct(name_of(2).alias("$result"))
    search = F.when((h == 0) & (turn % 4 < 2), call(first, "search", limit=turn, query=later)).when(h < 8, call(first, "search", limit=turn, query=query)).otherwise(call(first, "search", limit=F.lit("many"), query=query))
    calculate = F.when(h < 10, call(first, "calculate", expression=F.substr(text, F.lit(1), F.lit(8)))).otherwise(call(first, "calculate"))
    fetch = F.when(h < 12, call(first, "fetch", depth=F.lit(1), url=F.lit("u"))).otherwise(call(first, "fetch", url=F.lit(5)))
    own = F.when(h % 4 == 0, search).when(h % 4 == 1, calculate).when(h % 4 == 2, fetch).otherwise(call(first, "lookup"))
    again = F.when((h % 6 == 0) & (turn % 4 > 1), call(name_of(-2), "search", query=F.lit("again")))
    calls = F.array_compact(F.array(F.when(h % 5 != 4, own), again, F.when(h % 7 == 0, call(None, "calculate", expression=F.lit("1+1")))))
    content = F.coalesce(F.to_json(F.struct(text.alias("content"))), F.lit("{}"))

    def inside(start: Column, field: str, value: Column) -> Column:
        return F.concat(F.substr(start, F.lit(1), F.length(start) - 1), F.when(F.length(start) > 2, ",").otherwise(""), F.lit(f'"{field}":'), value, F.lit("}"))

    asked = inside(content, "tool_calls", F.concat(F.lit("["), F.array_join(calls, ","), F.lit("]")))
    answers = F.when(h % 3 == 1, name_of(-1)).when(h % 6 == 2, name_of(1)).otherwise(F.lit("gone"))
    told = inside(content, "tool_call_id", F.concat(F.lit('"'), answers, F.lit('"')))
    is_call, is_result = (F.col("role") == "assistant") & (F.size(calls) > 0), (F.col("role") == "user") & (turn > 0) & (h % 3 != 0)
    return conversations.select("conv_id", "turn", F.when(is_result, "tool").otherwise(F.col("role")).alias("role"), F.when(is_call, asked).when(is_result, told).otherwise(text).alias("text"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, with tool calls (see with_tool_calls), linked, ordered, checked and serialised; cases as in chat.format_chat."""
    told = chat.format_chat(with_tool_calls(_table(spark, sf_dir, "conversations")), chat.tool_schemas(spark, TOOLS), Scratch(spark, "op6"))
    return told.withColumn("problems", F.array_join("problems", ","))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text. Cases as in wordpiece.token_counts."""
    return wordpiece.token_counts(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), bare_mark=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text by a classifier that never saw the held-out labels. Cases as in toxicity.classify_toxicity."""
    scored = toxicity.classify_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), Scratch(spark, "op8"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector. Cases as in vectors.link_vectors."""
    return vectors.link_vectors(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op9")).select("vec_id", "n_links", "component_id", "kept")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document. Cases as in jaccard.jaccard_components."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_substring_dedup, op3_source_mixing, op4_private_data, op5_quality_rules, op6_chat_formatting, op7_token_counts, op8_toxicity, op9_embedding_near_dedup, op10_ngram_jaccard)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: A table of components(node, component) from links(a, b): the smallest node within reach.
_COMPONENTS = """
reach(node, seen) AS (
  SELECT a, a FROM links UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
),
components AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""



def _chat_sql() -> str:
    """The rows of op6 by joins over the calls and results of with_tool_calls; dependencies there are at most three messages deep."""
    places = [f"""p{i + 1} AS (SELECT n.conv_id, n.turn, CASE WHEN n.turn <= m.last.at THEN m.last.at ELSE n.turn END AS at, CASE WHEN n.turn <= m.last.at THEN m.last.depth + 1 ELSE 0 END AS depth
  FROM rows n LEFT JOIN (SELECT l.conv_id, l.turn, max({{'at': p.at, 'depth': p.depth}}) AS last FROM needs l JOIN p{i} p ON p.conv_id = l.conv_id AND p.turn = l.needs GROUP BY 1, 2) m ON m.conv_id = n.conv_id AND m.turn = n.turn)""" for i in range(4)]
    return """
WITH rows AS (SELECT conv_id, turn, text, (conv_id * 7 + turn * 3) % 20 AS h, CASE WHEN role = 'user' AND turn > 0 AND ((conv_id * 7 + turn * 3) % 20) % 3 <> 0 THEN 'tool' ELSE role END AS role FROM conversations),
own AS (SELECT conv_id, turn, 1 AS nth, 'c' || turn AS id, ['search', 'calculate', 'fetch', 'lookup'][h % 4 + 1] AS name, CASE WHEN h = 0 AND turn % 4 < 2 THEN 'c' || (turn + 2) END AS wants,
  CASE h % 4 WHEN 0 THEN '{"limit":' || CASE WHEN h < 8 THEN CAST(turn AS VARCHAR) ELSE '"many"' END || ',"query":' || CASE WHEN h = 0 AND turn % 4 < 2 THEN '{"$result":"c' || (turn + 2) || '"}' ELSE CAST(to_json(substr(text, 1, 12)) AS VARCHAR) END || '}'
    WHEN 1 THEN CASE WHEN h < 10 THEN '{"expression":' || CAST(to_json(substr(text, 1, 8)) AS VARCHAR) || '}' ELSE '{}' END WHEN 2 THEN CASE WHEN h < 12 THEN '{"depth":1,"url":"u"}' ELSE '{"url":5}' END ELSE '{}' END AS arguments,
  CASE h % 4 WHEN 0 THEN CASE WHEN h >= 8 THEN 'type:limit' END WHEN 1 THEN CASE WHEN h >= 10 THEN 'missing:expression' END WHEN 2 THEN CASE WHEN h < 12 THEN 'unknown:depth' ELSE 'type:url' END ELSE 'tool' END AS problem FROM rows WHERE role = 'assistant' AND h % 5 <> 4),
calls AS (SELECT * FROM own
  UNION ALL SELECT conv_id, turn, 2, 'c' || (turn - 2), 'search', NULL, '{"query":"again"}', NULL FROM rows WHERE role = 'assistant' AND h % 6 = 0 AND turn % 4 > 1
  UNION ALL SELECT conv_id, turn, 3, NULL, 'calculate', NULL, '{"expression":"1+1"}', 'missing:id' FROM rows WHERE role = 'assistant' AND h % 7 = 0),
results AS (SELECT conv_id, turn, CASE WHEN h % 3 = 1 THEN 'c' || (turn - 1) WHEN h % 6 = 2 THEN 'c' || (turn + 1) ELSE 'gone' END AS id FROM rows WHERE role = 'tool'),
first_call AS (SELECT conv_id, id, min(turn) AS call_turn FROM calls WHERE id IS NOT NULL GROUP BY 1, 2),
linked AS (SELECT r.*, c.call_turn FROM results r JOIN first_call c ON c.conv_id = r.conv_id AND c.id = r.id),
answer AS (SELECT conv_id, id, call_turn, min(turn) AS result_turn FROM linked GROUP BY 1, 2, 3),
needs AS (SELECT c.conv_id, c.turn, a.result_turn AS needs FROM calls c JOIN answer a ON a.conv_id = c.conv_id AND a.id = c.wants UNION SELECT conv_id, turn, call_turn FROM linked),
p0 AS (SELECT conv_id, turn, turn AS at, 0 AS depth FROM rows),
""" + ",\n".join(places) + """,
told AS (SELECT c.conv_id, c.turn, count(*) AS n_calls, count(a.result_turn) AS n_linked, array_to_string(list_sort(list(CASE WHEN c.id IS NULL THEN problem ELSE c.id || ':' || problem END) FILTER (problem IS NOT NULL)), ',') AS problems,
  string_agg('{"arguments":' || arguments || CASE WHEN c.id IS NULL THEN '' ELSE ',"id":"' || c.id || '"' END || ',"name":"' || name || '"}', ',' ORDER BY nth) AS lines FROM calls c LEFT JOIN answer a ON a.conv_id = c.conv_id AND a.id = c.id AND a.call_turn = c.turn GROUP BY 1, 2)
SELECT r.conv_id, r.turn, r.role, p.at, CAST(p.depth AS BIGINT) AS depth,
  '{"content":' || CAST(to_json(r.text) AS VARCHAR) || ',"role":"' || r.role || '"' || CASE WHEN s.id IS NULL THEN '' ELSE ',"tool_call_id":"' || s.id || '"' END || CASE WHEN t.lines IS NULL THEN '' ELSE ',"tool_calls":[' || t.lines || ']' END || '}' AS message_json,
  CAST(coalesce(t.n_calls, 0) AS BIGINT) AS n_calls, CAST(coalesce(t.n_linked, 0) AS BIGINT) AS n_linked, coalesce(t.problems, '') AS problems, s.id IS NOT NULL AND a.result_turn IS NULL AS orphan
FROM rows r JOIN p4 p ON p.conv_id = r.conv_id AND p.turn = r.turn LEFT JOIN told t ON t.conv_id = r.conv_id AND t.turn = r.turn LEFT JOIN results s ON s.conv_id = r.conv_id AND s.turn = r.turn LEFT JOIN answer a ON a.conv_id = s.conv_id AND a.id = s.id AND a.result_turn = s.turn"""


ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM starts),
earliest AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
hit AS (SELECT w.doc_id, w.i FROM windows w JOIN earliest e USING (h) WHERE e.first_doc < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM hit),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)""",
    "op3_source_mixing": f"""
WITH docs AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM docs GROUP BY source),
total AS (SELECT sum(source_size) AS words, sum(weight) AS weights FROM sources),
ranked AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio, coalesce(sum(3 * source_size) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS used FROM sources
  WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT ratio, CAST(words - capped AS DOUBLE) / CAST(weights - used AS DOUBLE) AS level FROM ranked, total),
level AS (SELECT coalesce(arg_min(level, ratio) FILTER (ratio >= level), 0) AS level FROM levels),
targets AS (SELECT source, source_size, CASE WHEN CAST(3 * source_size AS DOUBLE) < level * weight THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target FROM sources, level),
ahead AS (SELECT d.*, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS part FROM ahead)
SELECT doc_id, size, source_size, target, CAST(epochs * size + part AS BIGINT) AS taken, CAST(epochs AS BIGINT) AS epochs, CAST(part AS BIGINT) AS part FROM parts""",
    "op6_chat_formatting": _chat_sql(),
    "op9_embedding_near_dedup": f"""
WITH RECURSIVE links(a, b) AS (
  SELECT x.vec_id, y.vec_id FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) >= 0.98),
{_COMPONENTS}
SELECT e.vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS BIGINT) AS n_links, coalesce(c.component, e.vec_id) AS component_id, coalesce(c.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN components c ON c.node = e.vec_id""",
    "op10_ngram_jaccard": f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, '<' || array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links(a, b) AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
{_COMPONENTS}
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN components c ON c.node = w.doc_id""",
}
