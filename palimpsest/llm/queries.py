"""One registered query for each operator of this folder, over its whole table.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, sql | None)``. The operators' work (hash
functions, models, tokenizers, trees) has no SQL form; tests compare them with brute force,
round trips and held-out labels."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..session import table
from . import bottom_k, ctw, fill_middle, fingerprints, html_text, langid, line_dedup, lsh_forest, near_dedup, packing, pivot_codes, sentencepieces, token_files
from .common import held_out, shared_dir, stored

QUERIES: dict = {}

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("PALIMPSEST_TOKENIZERS", "/opt/tokenizers")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


@query("op1_lsh_forest")
def op1(spark, sf):
    return lsh_forest.search(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op2_language_id")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    held = held_out(F.col("doc_id"), 5, 0)
    model = langid.train(docs.select("doc_id", "text", "lang").where(~held))
    found = langid.predict(docs.select("doc_id", "text"), model, "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op3_sentencepiece_dropout")
def op3(spark, sf):
    return sentencepieces.encode_documents(table(spark, sf, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", rate=0.1, seed=20)


@query("op4_simhash_near_dedup")
def op4(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"), width=3, max_bits=3)


@query("op5_fingerprints")
def op5(spark, sf):
    return fingerprints.edited_likeness(table(spark, sf, "documents"))


@query("op6_token_files")
def op6(spark, sf):
    path = shared_dir(spark, "tokens")
    ids = token_files.encode_documents(table(spark, sf, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", end_id=1, blanks_kept=False)
    token_files.write_tokens(ids, path)
    return token_files.digests(token_files.read_tokens(spark, path))


@query("op7_best_fit_packing")
def op7(spark, sf):
    return packing.pack(table(spark, sf, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", end_id=2, blanks_kept=True, capacity=1024)


@query("op8_html_extraction")
def op8(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


@query("op9_lm_scoring")
def op9(spark, sf):
    return ctw.score_documents(table(spark, sf, "documents"), held_out(F.col("doc_id"), 7, 2))


@query("op10_line_dedup")
def op10(spark, sf):
    found = line_dedup.line_classes(table(spark, sf, "documents"))
    return found.select("doc_id", "line_no", "kept", "first_doc_id", "first_line_no")


_FORM = "CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END"


@query("op11_fill_in_middle", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id) AS h FROM documents),
h AS (SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, {_FORM} AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""")
def op11(spark, sf):
    made = fill_middle.transform(table(spark, sf, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op12_pivot_codes")
def op12(spark, sf):
    coded, books = pivot_codes.encode(table(spark, sf, "embeddings"))
    found = pivot_codes.with_label_error(stored(coded, "coded"))
    return found.select("vec_id", pivot_codes.code_string(F.col("codes")).alias("code"), "error", "label_error",
                        F.lit(books.digest() if books else None).alias("codebooks_sha256"))


@query("op13_bottom_k_dedup")
def op13(spark, sf):
    return bottom_k.near_duplicates(table(spark, sf, "documents"))
