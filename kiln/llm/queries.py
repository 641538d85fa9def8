"""One registered query for each operator, over whole tables; ``(spark, sf_dir)`` -> DataFrame.

A query applies its operator with production parameters and derives the columns that are
compared (counts, digests) from the operator's own output."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.llm import (
    bpe_automaton, chunk_bpe, collocations, decontaminate, minhash_dedup, quality_ranking, quality_rules, ranked_search, secret_scan,
    site_style_tree, substring_dedup, token_files, url_filter)
from kiln.llm.common import table

#: Folder of the public vocabulary files: a parameter of the package that installs them.
def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scan(spark, sf_dir):
    """Secrets of every document: counts of the base kinds, digest of the base spans, all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", of("assign"), of("access"), of("hex"),
                        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.spans_text(F.col("spans")).alias("spans"))


def op2_token_files(spark, sf_dir):
    """Ids of every document, written to token files and read back: place, number and checksum."""
    path = token_files.encode_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.with_crc32(token_files.read_files(spark, path))


def op3_decontamination(spark, sf_dir):
    """Pairs of a document and a benchmark item that it holds."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark, sf_dir):
    """Figures, base verdict and posterior verdict of every document."""
    judged = quality_rules.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


def op5_minhash_dedup(spark, sf_dir):
    """Component of every document over near-duplicate links, and whether it is the one kept."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_site_style_tree(spark, sf_dir):
    """Main text of every page."""
    done = site_style_tree.extract(table(spark, sf_dir, "pages"))
    return done.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_substring_dedup(spark, sf_dir):
    """Words of every document before and after passages that occur elsewhere are removed."""
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.sha2(F.col("kept").cast("binary"), 256), F.col("digest"))
    return done.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op8_url_filter(spark, sf_dir):
    """Verdict on every page's url, by rule or by the words of its host and path."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_quality_ranking(spark, sf_dir):
    """Quality score of every document."""
    done = quality_ranking.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.withColumn("predicted", (F.col("score") >= quality_ranking.THRESHOLD).cast("int"))


def op10_bpe_automaton(spark, sf_dir):
    """Ids of every document by the automaton, and the text they decode to, as digests."""
    done = bpe_automaton.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return done.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_collocations(spark, sf_dir):
    """The 2000 best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_chunk_bpe(spark, sf_dir):
    """Ids of every document by the rank file, taken in overlapping chunks, and the bytes they decode to."""
    import public_tokenizers
    done = chunk_bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN)
    return done.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_token_files, op3_decontamination, op4_quality_rules, op5_minhash_dedup, op6_site_style_tree,
    op7_substring_dedup, op8_url_filter, op9_quality_ranking, op10_bpe_automaton, op11_collocations,
    op12_chunk_bpe,
    op13_ranked_search)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: Every phrase of 1 to 4 words as a list, cut at each place, and each longer one's inner phrases.
LLM_ORACLE: dict[str, str] = {
    "op11_collocations": f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
     p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
     g AS (SELECT lang, unnest(flatten(list_transform(range(1, len(ws) + 1),
                  lambda i: list_transform(range(i, least(i + 4, len(ws) + 1)), lambda j: ws[i:j])))) AS ph FROM w),
     f AS (SELECT lang, ph, count(*) AS f FROM g GROUP BY ALL),
     n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(ph) = 1 GROUP BY ALL),
     c AS (SELECT lang, ph, f AS a FROM f WHERE len(ph) > 1 AND f >= 30),
     k AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS cut FROM c),
     s AS (SELECT k.lang, k.ph, k.a, k.cut, x.f AS l, y.f AS r,
                  ((2000000::HUGEINT * k.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
           FROM k JOIN f x ON x.lang = k.lang AND x.ph = k.ph[1:k.cut]
                  JOIN f y ON y.lang = k.lang AND y.ph = k.ph[k.cut + 1:]),
     b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) = 1),
     i AS (SELECT lang, a AS longer, unnest(flatten(list_transform(range(1, len(ph)),
                  lambda i: list_transform(range(i + 1, len(ph) + 1), lambda j: ph[i:j])))) AS ph, len(ph) AS long FROM c),
     m AS (SELECT lang, ph, max(longer) AS longer FROM i WHERE len(ph) < long AND len(ph) > 1 GROUP BY ALL),
     o AS (SELECT b.*, array_to_string(b.ph, ' ') AS phrase FROM b LEFT JOIN m USING (lang, ph)
           WHERE m.longer IS NULL OR 100::HUGEINT * m.longer < 80::HUGEINT * b.a),
     r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
                  phrase, a, l, r, score FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_ranked_search": f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
     p AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
     n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY ALL),
     s AS (SELECT count(*) AS cn, sum(n)::BIGINT AS cl FROM n),
     m AS (SELECT doc_id, 50 + (50 * n * cn) // cl AS m FROM n, s),
     w AS (SELECT term, floor(1000 * ln((2 * cn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM p, s GROUP BY term, cn),
     q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
     r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
     o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                  doc_id, score FROM r WHERE score > 0)
SELECT * FROM o WHERE rank <= 50""",
}
