"""One query per corpus operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm.bpe import BpeEncoder
from residua.llm.common import small_batches
from residua.llm.fim import FillInMiddle
from residua.llm.language import LanguageEvidence
from residua.llm.line_dedup import LineDedup
from residua.llm.mixing import SourceMix
from residua.llm.ngram_join import NgramJoin
from residua.llm.pii import Pseudonyms
from residua.llm.preference import PreferenceFormat
from residua.llm.quality import QualityRules
from residua.llm.topk import BitSlicedIndex
from residua.llm.toxicity import Toxicity
from residua.llm.url_filter import UrlFilter
from residua.llm.whitening import Whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_bpe_path() -> str:
    """The public word-level vocabulary; any other file of this kind serves as well."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").where("quality = 1")
    judged = QualityRules().fit(docs, trusted).score(docs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query("op2_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = SourceMix().plan(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op3_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of a fifth of the ids are held out; the model never sees them."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = Toxicity().fit(docs, labels.where(~held_out)).score(docs)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op4_pii_pseudonyms")
def pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return Pseudonyms().apply(table(spark, folder, "documents")).select("doc_id", "text", "n_replaced", "kinds")


@query("op5_bpe_encoding")
def bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return BpeEncoder(word_bpe_path()).digest(table(spark, folder, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query(
    "op6_preference_format",
    """
    WITH r AS (SELECT conv_id, min(turn) AS first, max(turn) AS last, arg_max(text, turn) AS own FROM conversations WHERE role = 'assistant' GROUP BY 1),
    n AS (SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS next FROM r),
    s AS (
      SELECT n.conv_id, n.last, CASE WHEN n.conv_id % 3 = 0 THEN n.last ELSE n.first END AS begin_turn, CASE WHEN n.conv_id % 3 = 2 THEN n.first ELSE n.last END AS end_turn, o.own AS other
      FROM n JOIN r o ON n.next = o.conv_id WHERE n.next <> n.conv_id),
    chosen AS (SELECT conv_id, 'chosen' AS side, turn, role, text FROM conversations JOIN s USING (conv_id) WHERE turn <= last),
    rejected AS (
      SELECT conv_id, 'rejected' AS side, turn, role, CASE WHEN role = 'assistant' AND turn >= begin_turn THEN other ELSE text END AS text
      FROM conversations JOIN s USING (conv_id) WHERE turn <= end_turn),
    d AS (
      SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, min(coalesce(a.turn, b.turn)) AS split FROM chosen a FULL JOIN rejected b ON a.conv_id = b.conv_id AND a.turn = b.turn
      WHERE a.side IS NULL OR b.side IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1)
    SELECT conv_id AS pair_id, CASE WHEN turn < split THEN 'prompt' ELSE side END AS part, turn, role, '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
      CAST(CASE WHEN turn >= split AND role = 'assistant' THEN 1 ELSE 0 END AS INTEGER) AS loss
    FROM (SELECT * FROM chosen UNION ALL SELECT * FROM rejected) JOIN d USING (conv_id) WHERE turn >= split OR side = 'chosen'
    UNION ALL
    SELECT DISTINCT conv_id, 'unpaired', NULL, NULL, NULL, 0 FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM d)
    """,
)
def preference_format(spark: SparkSession, folder: str) -> DataFrame:
    """One row per rendered turn; a conversation without a reply is one row of part unpaired."""
    return PreferenceFormat().format_single(table(spark, folder, "conversations"))


@query("op7_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return NgramJoin(n=3, percent=90).join(table(spark, folder, "documents"))


@query("op8_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return LineDedup().apply(table(spark, folder, "documents"))


@query("op9_language_evidence")
def language_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return LanguageEvidence().fit(table(spark, folder, "documents")).identify(table(spark, folder, "pages"))


@query(
    "op10_bit_sliced_topk",
    """
    WITH v AS (
      SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows, search = table(spark, folder, "embeddings"), BitSlicedIndex()
    return search.search(search.build(rows), rows.where("vec_id % 50 = 0"))


@query(
    "op11_fill_in_middle",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    l AS (
      SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
    c AS (
      SELECT *, len(lines) AS n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
    p AS (
      SELECT doc_id, n, form, text, array_to_string(lines[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS front,
        array_to_string(lines[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
        array_to_string(lines[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS back FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(front) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || front || '<S>' || back || '<M>' || middle ELSE '<S>' || back || '<P>' || front || '<M>' || middle END) AS output_sha256,
      sha256(CASE form WHEN 'plain' THEN text ELSE front || middle || back END) AS restored_sha256
    FROM p
    """,
)
def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = FillInMiddle().digest(table(spark, folder, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


#: Fixed rules of the query: host and path, verdict.
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Fixed words of hosts whose pages are no training text; they decide where no rule fits.
HOST_WORDS = ("adult", "betting", "casino", "gambling", "pills", "poker", "porn", "viagra", "xxx")


@query(
    "op12_url_filter",
    f"""
    WITH u AS (SELECT row_number() OVER () AS i, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS own FROM u),
    s AS (
      SELECT i, page_id, translate(own, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(own) + 1), '^[^?#]*') AS path FROM h),
    r AS (SELECT *, split_part(rule, '/', 1) AS r_host, substr(rule, instr(rule, '/')) AS r_path FROM (VALUES {", ".join(str(r) for r in URL_RULES)}) v(rule, verdict)),
    f AS (
      SELECT i, rule, verdict, row_number() OVER (PARTITION BY i ORDER BY length(rule) DESC, length(r_host) DESC) AS place
      FROM s JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
    w AS (SELECT i, min(word) AS word FROM (SELECT i, unnest(string_split_regex(host, '[.-]')) AS word FROM s) WHERE word IN {HOST_WORDS} GROUP BY 1)
    SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN word END AS word, coalesce(verdict, CASE WHEN word IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM s LEFT JOIN f ON f.i = s.i AND place = 1 LEFT JOIN w ON w.i = s.i
    """,
)
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    entries = spark.createDataFrame([*URL_RULES, *[(w, "block") for w in HOST_WORDS]], "entry string, verdict string")
    judged = UrlFilter().build(entries).judge(table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "word", "verdict")


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """One row per vector and direction."""
    rows = table(spark, folder, "embeddings")
    model = Whitening(components=4).fit(rows)
    shares = F.array(*[F.lit(e).cast("double") for e in model.explained]) if model.explained else F.array().cast("array<double>")
    each = model.transform(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    error = F.lit(model.identity_error).cast("double").alias("identity_error")
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), error)
