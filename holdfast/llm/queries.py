"""The operators over their whole tables with production parameters, one query each, and the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import alignment, archives, chat, collocations, decontaminate, licenses, lm, pieces, quality, shards, simhash, token_counts, toxicity
from holdfast.llm.common import text_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, at most four of 64 bits apart."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), simhash.Ring())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base verdict and the whole rule table's verdict on every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    m = "quality_measures"
    return quality.judge(docs).select(
        "doc_id", *[f"{m}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept", F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def op3_mixed_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the unigram base and under the mixed model, learned from the rest of the table."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    return lm.score(docs).select(columns)


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24 and its slot there, and its shard of 25."""
    return shards.shard_records(_table(spark, sf_dir, "documents"), [1.0] * 24, grown=1.0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    turns = _table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digest(chat.format_conversations(turns.select("conv_id", "turn", "role", "text").unionByName(own)))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document names: the best-covered one, and all of them with the words they stand in."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    best = F.array_sort("licenses", lambda a, b: F.when(a["coverage"] != b["coverage"], F.when(a["coverage"] > b["coverage"], -1).otherwise(1)).otherwise(
        (a["start"] - b["start"]).cast("int")))
    spans = F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.get(best, F.lit(0))["license"].alias("license"),
        F.get(best, F.lit(0))["coverage"].alias("coverage"), F.array_join(spans, ",").alias("places"),
    )


def op7_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether they decode to its text (U+2581 read as the space that the model takes it for)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    both = pieces.encode(docs, decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        (F.col("decoded") == F.translate("text", pieces.SPACE, " ")).alias("round_trip"),
    )


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of each category of the chain, and whether it is toxic."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    models = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    told = toxicity.classify(docs, models)
    return told.select("doc_id", *[F.col(f"toxicity.{c.name}").alias(f"p_{c.name}") for c in toxicity.CATEGORIES], toxicity.is_toxic().alias("toxic"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select(
        "doc_id", F.octet_length(text_of("text")).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit")
    )


def op10_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item, and the items."""
    docs, items = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    c = "contamination"
    hit = F.aggregate(f"{c}.spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return decontaminate.contamination(docs, items).select(
        "doc_id", f"{c}.n_words", hit.alias("n_hit"), F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"), (F.size(f"{c}.spans") > 0).alias("contaminated"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of two or three words by the score of their weakest cut."""
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the byte-level and the piece tokens of every document, links judged by the whole table."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = F.col("alignment.groups")
    digest = F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    aligned = alignment.align(docs).select("doc_id", F.col("alignment").withField("groups", digest).alias("alignment"))
    counted = [f"alignment.{c}" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return alignment.score_alignments(aligned).select("doc_id", *counted, F.col("alignment.groups").alias("groups_sha256"))


def op13_page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into an archive as a WARC record, and what reading the archives by ranges gives back."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = archives.read_records(archives.write_archives(pages))
    return archives.page_records(records, pages.schema["page_id"].dataType.simpleString())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_simhash_components": op1_simhash_components,
    "op2_quality_rules": op2_quality_rules,
    "op3_mixed_lm": op3_mixed_lm,
    "op4_rendezvous_shards": op4_rendezvous_shards,
    "op5_chat_format": op5_chat_format,
    "op6_license_scan": op6_license_scan,
    "op7_piece_ids": op7_piece_ids,
    "op8_toxicity_chain": op8_toxicity_chain,
    "op9_token_counts": op9_token_counts,
    "op10_benchmark_windows": op10_benchmark_windows,
    "op11_collocations": op11_collocations,
    "op12_token_alignment": op12_token_alignment,
    "op13_page_archives": op13_page_archives,
}

#: SQL's words: as the operators cut them.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "op5_chat_format": r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, [length(regexp_replace(replace(x, chr(92), chr(92) || chr(92)), '(<)(/s>|s>)|(\[)(/INST\]|INST\])', '\1\3' || '_' || '\2\4', 'g')) for x in [role, text]] as n from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
       cast(sum(n[1] + n[2] + 23) as bigint) as formatted_chars
from e group by conv_id""",
    "op10_benchmark_windows": r"""
with d as (select doc_id, list_filter(string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws
           from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii from documents)),
b as (select item_id, list_filter(string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws
      from (select item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii from benchmark)),
wins as (select distinct item_id, least(len(ws), 10) as n, list_slice(ws, i, i + least(len(ws), 10) - 1) as win
         from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from b where len(ws) > 0)),
sizes as (select distinct n from wins),
spots as (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, sizes where len(ws) >= n),
hits as (select s.doc_id, s.i, s.n, w.item_id from (select doc_id, n, i, list_slice(ws, i, i + n - 1) as win from spots) s join wins w on s.n = w.n and s.win = w.win),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
          from (select distinct doc_id, cast(item_id as varchar) as name from hits) group by doc_id)
select d.doc_id, len(d.ws) as n_words, coalesce(w.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
       sha256(coalesce(i.names, '')) as items_sha256, coalesce(w.n_hit, 0) > 0 as contaminated
from d left join words w on d.doc_id = w.doc_id left join items i on d.doc_id = i.doc_id""",
    "op11_collocations": r"""
with texts as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws
           from (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from texts)),
spots as (select lang, ws, s, unnest(range(1, len(ws) - s + 2)) as i from pieces, range(1, 4) as sizes(s) where len(ws) >= s),
f as (select lang, s, list_slice(ws, i, i + s - 1) as ws, count(*) as a from spots group by all),
totals as (select lang, cast(sum(a) as bigint) as n from f where s = 1 group by lang),
cand as (select * from f where s > 1 and a >= 10),
cuts as (select c.lang, c.ws, c.a, k, x.a as l, y.a as r, cast(1000000 as hugeint) * c.a * c.a // (cast(x.a as hugeint) * y.a) as score
         from (select *, unnest(range(1, s)) as k from cand) c
         join f x on x.lang = c.lang and x.ws = list_slice(c.ws, 1, k) join f y on y.lang = c.lang and y.ws = list_slice(c.ws, k + 1, c.s)),
weakest as (select * from cuts qualify row_number() over (partition by lang, ws order by score, k) = 1),
inside as (select lang, unnest([list_slice(ws, 1, 2), list_slice(ws, 2, 3)]) as ws, a from cand where s = 3),
gone as (select distinct w.lang, w.ws from weakest w join inside i on w.lang = i.lang and w.ws = i.ws where 100 * i.a >= 50 * w.a),
named as (select w.*, array_to_string(w.ws, ' ') as phrase from weakest w anti join gone g on w.lang = g.lang and w.ws = g.ws),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, cast(r.score as bigint) as score from ranked r join totals t on r.lang = t.lang where r.rank <= 2000""",
    "op13_page_archives": r"""
with p as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages),
g as (select *, row_number() over (partition by digest order by page_id nulls last) as place, first_value(page_id) over (partition by digest order by page_id nulls last) as first from p)
select page_id, n as payload_bytes, digest as payload_digest, case when n >= 100 and place > 1 then 'revisit' else 'response' end as record_type,
       case when n >= 100 and place > 1 then first end as refers_to
from g""",
}
