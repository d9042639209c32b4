"""The registered queries of this subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recallspark.llm.alignment import alignment
from recallspark.llm.byte_bpe import encode_documents
from recallspark.llm.decontaminate import find_leaks
from recallspark.llm.exact_dedup import exact_dedup
from recallspark.llm.fill_in_middle import fill_in_middle, restored
from recallspark.llm.jaccard_join import jaccard_components
from recallspark.llm.katz import katz_scores
from recallspark.llm import language_mixture, toxicity
from recallspark.llm.language_mixture import remainder
from recallspark.llm.licences import scan_licences
from recallspark.llm.personal_data import find_personal_data, span_digest
from recallspark.llm.token_files import token_files
from recallspark.llm.warc import archived


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file, for the parameter of the operators."""
    import public_tokenizers
    return public_tokenizers.path(name)



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages, likelihoods = language_mixture.train(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    return language_mixture.identify(docs, languages, likelihoods).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "languages")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
short AS (SELECT DISTINCT len(w) AS k FROM b WHERE len(w) BETWEEN 1 AND 4),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) >= 5
       UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) FROM d JOIN short ON len(w) >= k),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 75"""


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    encoded = encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN, decoded=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(remainder(F.col("doc_id"), 4) != 2))
    return toxicity.score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 1)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("n_links_found")


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS x, y.doc_id AS y FROM s x JOIN s y USING (s) JOIN n a ON a.doc_id = x.doc_id JOIN n b ON b.doc_id = y.doc_id
      GROUP BY x.doc_id, y.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, p.y FROM r JOIN p ON p.x = r.c)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id"""


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(find_personal_data(table(spark, sf_dir, "documents")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
             sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS x FROM t),
c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 100 THEN 'plain'
             WHEN x[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


OP12_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM p"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


ENTRIES = {
    "op13_alignment": (op13, None),
    "op12_warc": (op12, OP12_SQL),
    "op11_fill_in_middle": (op11, OP11_SQL),
    "op7_katz": (op7, None),
    "op8_licences": (op8, None),
    "op9_jaccard_join": (op9, OP9_SQL),
    "op10_personal_data": (op10, None),
    "op6_toxicity": (op6, None),
    "op1_language_mixture": (op1, None),
    "op2_token_files": (op2, None),
    "op3_decontaminate": (op3, OP3_SQL),
    "op4_exact_dedup": (op4, OP4_SQL),
    "op5_byte_bpe": (op5, None),
}
