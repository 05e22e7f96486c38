"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them.

Each ``op*`` query applies its operator, with production parameters, to its
whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.llm import (
    bpe,
    chat,
    collocations,
    compression,
    exact_dedup,
    lexical,
    mixing,
    quality_classifier,
    sentence_spans,
    simhash,
    suffix_dedup,
    warc,
    wordpiece,
)

from regline.llm.common import written
from regline.session import fresh_dir, ship_package


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_classifier(spark, sf):
    docs, labels = _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "labels")
    model = quality_classifier.fit(docs, labels, usable=~quality_classifier.held_out(F.col("doc_id")))
    scored = docs.select("doc_id", quality_classifier.score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def public_tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_byte_bpe(spark, sf):
    tokenizer = public_tokenizer(spark)
    coded = _table(spark, sf, "documents").select("doc_id", tokenizer.round_trip(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id",
        bpe.n_tokens(F.col("coded.ids")).alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op3_warc(spark, sf):
    folder = fresh_dir(spark, "archives")
    warc.write(_table(spark, sf, "pages").select("page_id", "url", "html"), folder)
    read = warc.read(spark, folder)
    page = F.nullif(F.split_part("record_id", F.lit(":"), F.lit(3)), F.lit("")).cast("bigint")
    records = written(
        read.select(
            page.alias("page_id"),
            "record_id",
            "record_type",
            "refers_to",
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            warc.sha1_base32(F.col("payload")).alias("payload_digest"),
        ),
        "records",
    )
    # A revisit has no payload of its own: its length and digest are those of the record it refers to.
    full = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type")
    first = records.where("record_type = 'response'").select(
        F.col("record_id").alias("first_id"), F.col("page_id").alias("first_page"), "payload_bytes", "payload_digest"
    )
    revisits = records.where("record_type = 'revisit'").select("page_id", "refers_to", "record_type")
    resolved = revisits.join(first, F.col("refers_to") == F.col("first_id")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("first_page").alias("refers_to")
    )
    return full.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(resolved)


def op4_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(_table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_chat_formatting(spark, sf):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_trees(chat.as_trees(turns))
    read = formatted.select(
        F.col("tree").alias("conv_id"),
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_source_mixing(spark, sf):
    mixed = mixing.mixed_counts(_table(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixed.withColumnRenamed("id", "doc_id")


def op7_token_counts(spark, sf):
    import public_tokenizers

    docs = _table(spark, sf, "documents")
    counter = wordpiece.TokenCounter(spark, public_tokenizers.path("piece_bpe_32k.model"))
    return docs.select("doc_id", counter.count(F.col("text")).alias("counts")).select("doc_id", "counts.*")


def op8_compression_rules(spark, sf):
    docs = _table(spark, sf, "documents")
    ship_package(spark)
    judged = docs.select("doc_id", compression.judge(F.col("text")).alias("judged"))
    return judged.select("doc_id", "judged.*")


def op9_sentence_spans(spark, sf):
    return sentence_spans.remove_repeats(_table(spark, sf, "documents").select("doc_id", "text"), total="n_sentences")


def op10_exact_dedup(spark, sf):
    index = exact_dedup.open_index(spark)
    judged = exact_dedup.dedup_batch(_table(spark, sf, "documents").select("doc_id", "text"), index)
    return judged.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents").select("lang", "text"))


def op12_lexical_search(spark, sf):
    items = _table(spark, sf, "benchmark").select("item_id", "text")
    return lexical.Index(_table(spark, sf, "documents").select("doc_id", "text"), items).search(items)


def op13_suffix_dedup(spark, sf):
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _escaped_length(column: str) -> str:
    """SQL: code points of ``column`` when escaped: one more for each backslash and each control string."""
    extra = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL)]
    return f"length({column}) + " + " + ".join(extra)


def _base32(digest: str) -> str:
    """SQL: base32 of a hexadecimal digest of 160 bits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = [
        f"substr('{alphabet}', ((('0x' || substr({digest}, {1 + 10 * i}, 10))::BIGINT >> {35 - 5 * j}) & 31)::INT + 1, 1)"
        for i in range(4)
        for j in range(8)
    ]
    return " || ".join(digits)


ORACLE_SQL: dict[str, str] = {
    "op3_warc": f"""
        WITH digested AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
             judged AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS first_page FROM digested)
        SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {_base32("digest")} AS payload_digest,
               CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_page THEN first_page END AS refers_to
        FROM judged
    """,
    "op5_chat_formatting": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum({len(chat.START + chat.SEPARATOR + chat.TURN_END)} + {_escaped_length("role")}
                   + {_escaped_length("text")})::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op10_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
    """,
    "op11_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'),
                                             '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ),
        worded AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces
        ),
        starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM worded),
        grams AS (SELECT lang, unnest([list_aggregate(ws[i:i + k - 1], 'string_agg', ' ') for k in generate_series(1, 5)
                                       if i + k - 1 <= len(ws)]) AS phrase FROM starts),
        counts AS (
            SELECT lang, phrase, string_split(phrase, ' ') AS ws, len(string_split(phrase, ' ')) AS words, count(*) AS f
            FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
        ),
        totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM worded GROUP BY lang),
        cuts AS (SELECT lang, phrase, ws, f AS a, unnest(generate_series(1, words - 1)) AS k FROM counts WHERE words > 1),
        scored AS (
            SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN totals t ON t.lang = c.lang
            JOIN counts x ON x.lang = c.lang AND x.phrase = list_aggregate(c.ws[1:k], 'string_agg', ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = list_aggregate(c.ws[k + 1:], 'string_agg', ' ')
        ),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        free AS (
            SELECT * FROM lowest s WHERE NOT EXISTS (
                SELECT 1 FROM counts c WHERE c.lang = s.lang AND c.words > len(string_split(s.phrase, ' '))
                    AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * c.f >= 100 * s.a)
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM free QUALIFY rank <= 2000
    """,
    "op12_lexical_search": f"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'),
                                                     '[^{lexical.BETWEEN}]+')) AS term
            FROM documents
        ),
        lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'),
                                                               '[^{lexical.BETWEEN}]+')) AS term
            FROM benchmark
        ),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM terms SEMI JOIN asked USING (term) GROUP BY doc_id, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, totals GROUP BY term, docs
        ),
        impacts AS (
            SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))) AS impact
            FROM counts JOIN lengths USING (doc_id), totals
        ),
        scores AS (
            SELECT item_id, doc_id, sum(w * impact)::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(w * impact) > 0
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scores QUALIFY rank <= 50
    """,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)
}
