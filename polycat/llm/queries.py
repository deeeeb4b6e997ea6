"""Queries opN_<name> over the corpus tables, and their SQL where SQL can say them."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polycat.llm import decontaminate, license_scan, line_dedup, merkle, minhash, mixing, neighbours, ngram, packing, secret_scan, spelling, sstable, toxicity
from polycat.llm.common import ascii_lower, table

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents"), license_scan.known_licenses(spark))
    return out.withColumn("matched", F.col("license_id").isNotNull())


def op3_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score_corpus(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_rates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2).alias("held_out"), "score", "predicted")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.encode_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.train)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _drop_one(doc_id: int | None):
    """The rule that op 12 asks for: one word in 97 of a document loses a letter."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), prefix)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), rule=_drop_one)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    out = merkle.manifest(table(spark, sf_dir, "documents"), lower)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict:
    return {f.__name__: f for f in (op1_neighbours, op2_license_scan, op3_ngram_scores, op4_mixing, op5_toxicity, op6_near_duplicates, op7_token_shards, op8_line_dedup, op9_decontaminate, op10_secret_scan, op11_packing, op12_spelling, op13_merkle)}


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = LOWER.format(f"coalesce({text}, '')")
    for pattern, stays in license_scan.STEPS:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(f'{chr(92)}{stays}' if isinstance(stays, int) else stays or ' ')}, 'g')"
    for old, new in license_scan.SAME:
        out = f"replace({out}, {_quoted(old)}, {_quoted(new)})"
    return f"trim({out})"


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; code points up to U+07FF."""
    byte = f"flatten(list_transform(string_split({text}, ''), lambda x: case when ord(x) < 128 then [ord(x)::bigint] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::bigint[] end))"
    bit = "lambda a, z: xor(a >> 1, case when (a & 1) = 1 then 3988292384 else 0 end)"
    return f"xor(list_reduce({byte}, lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], {bit}), 4294967295::bigint), 4294967295::bigint)"


def _field_sql(value: str) -> str:
    return f"case when {value} is null then '-' else strlen({value}::varchar) || ':' || {value}::varchar end"


def _tree_sql(name: str, of: str, leaves: str) -> str:
    """A recursive table of a tree's levels: level 0 is leaves, parents have their children's digests as pre."""
    return f"""{name} as ({leaves}
union all select lvl + 1, {of}pos // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' order by pos)), string_agg(digest, '' order by pos) from {name} where n > 1 group by lvl, {of}pos // 8)"""


def oracle_sql() -> dict[str, str]:
    lower = LOWER.format("text")
    leaf = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    changed = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", lower))
    texts = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in license_scan.LICENSES.items())
    digests = ", ".join(f"({_quoted(v)}, {_quoted(k)})" for k, v in [*license_scan.DIGESTS.items(), *license_scan.BARE.items()])
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return {
        "op2_license_scan": f"""
with known as (select sha256({_canonical_sql("t")}) digest, min(i) license_id from (values {texts}) v(i, t) group by 1 union all select * from (values {digests}) w(digest, i)),
d as (select doc_id, sha256({_canonical_sql("text")}) digest from documents)
select doc_id, digest, license_id, license_id is not null as matched from d left join known using (digest)""",
        "op6_near_duplicates": f"""
with recursive d as (select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') w from documents),
s as (select distinct doc_id, case when len(w) >= 4 then array_to_string(w[i:i + 3], ' ') else array_to_string(w, ' ') end g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from d where len(w) > 0)),
c as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) m from s a join s b using (g) where a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join c cx on cx.doc_id = x join c cy on cy.doc_id = y where 100 * m >= 80 * (cx.n + cy.n - m)),
e as (select x, y from l union all select y, x from l),
r as (select x, y from e union select r.x, e.y from r join e on r.y = e.x),
k as (select x, min(y) y from r group by 1)
select d.doc_id, coalesce(n, 0) n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) component_id, d.doc_id <= coalesce(y, d.doc_id) kept from d left join c using (doc_id) left join k on k.x = d.doc_id""",
        "op8_line_dedup": f"""
with l as (select doc_id, unnest(s) as line, generate_subscripts(s, 1) as pos from (select doc_id, string_split(coalesce(text, ''), chr(10)) s from documents)),
k as (select doc_id, pos, line, {LOWER.format(f"trim(line, {white})")} as key from l),
f as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.*, f.key is not null and k.doc_id <> f.last as lost from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256 from m group by doc_id""",
        "op9_decontaminate": f"""
with d as (select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
b as (select item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') g from (select item_id, w, least(10, len(w)) n, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from b where len(w) > 0)),
ns as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, ns where len(w) >= n)),
h as (select distinct doc_id, i, n, item_id from dw join bw using (n, g)),
p as (select doc_id, count(*) n_hit from (select distinct doc_id, unnest(range(i, i + n)) from h) group by 1),
s as (select doc_id, count(*) n_items, string_agg(x, ',' order by x) x from (select distinct doc_id, cast(item_id as varchar) x from h) group by 1)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(x, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated from d left join p using (doc_id) left join s using (doc_id)""",
        "op12_spelling": f"""
with recursive runs as (select doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) w from documents),
k as (select doc_id, w, count(*) n from runs where length(w) >= 5 group by 1, 2),
h as (select w, n, {_crc32_sql("coalesce(doc_id::varchar, '') || ':' || w")} h from k),
e as (select case when h % 97 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end word, n from h),
words as (select word, sum(n)::bigint n from e where length(word) >= 5 group by 1 having sum(n) >= 3),
v as (select word, n, i, left(word, i - 1) || substr(word, i + 1) d from (select word, n, unnest(range(1, length(word) + 1)) i from words)),
near as (select a.word, b.word other, b.n from v a join v b on a.i = b.i and a.d = b.d and a.word <> b.word
union select a.word, b.word, b.n from v a join words b on a.d = b.word union select b.word, a.word, a.n from v a join words b on a.d = b.word),
best as (select word, count(*) n_near, arg_min(other, (-n, other)) other, max(n) n from near group by 1),
t as (select w.word, w.n, coalesce(n_near, 0) n_near, case when b.n >= 2 * w.n then other end form, case when b.n >= 2 * w.n then b.n end form_n from words w left join best b using (word)),
r as (select word, word as tip, form from t union all select r.word, r.form, t.form from r join t on t.word = r.form)
select t.word, t.form, r.tip root, n, n_near, form_n from t join r on r.word = t.word where r.form is null""",
        "op13_merkle": f"""
with recursive d as (select doc_id, lang, sha256({leaf}) leaf, case when {_crc32_sql("doc_id::varchar")} % 3 = 0 then sha256({changed}) end changed from documents),
l as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 pos, count(*) over (partition by lang) n from d),
{_tree_sql("up", "lang, ", "select 0 lvl, lang, pos, n, leaf digest, '' pre from l")},
s as (select lang, digest, row_number() over (order by lang nulls first) - 1 pos, count(*) over () n from up where n = 1),
{_tree_sql("top", "", "select 0 lvl, pos, n, digest, '' pre from s")},
a as (select l.lang, l.pos, lvl, pre, (l.pos >> (3 * (lvl - 1))) % 8 slot from l join up u on u.lang is not distinct from l.lang and lvl > 0 and u.pos = l.pos >> (3 * lvl)
union all select l.lang, l.pos, 100 + lvl, pre, (s.pos >> (3 * (lvl - 1))) % 8 from l join s on s.lang is not distinct from l.lang join top t on lvl > 0 and t.pos = s.pos >> (3 * lvl)),
b as (select *, left(pre, slot * 64) x, substr(pre, slot * 64 + 65) y, row_number() over (partition by lang, pos order by lvl) i from a),
p as (select lang, pos, sha256(string_agg(x || y, '' order by i)) proof, max(i) last from b group by all),
f as (select lang, pos, 0 i, coalesce(changed, leaf) h from l
union all select f.lang, f.pos, b.i, sha256(x || h || y) from f join b on b.lang is not distinct from f.lang and b.pos = f.pos and b.i = f.i + 1)
select doc_id, leaf, s.digest subroot, r.digest root, coalesce(proof, sha256('')) proof_sha256, h folded_root, h = r.digest verified
from l join s on s.lang is not distinct from l.lang cross join (select digest from top where n = 1) r left join p on p.lang is not distinct from l.lang and p.pos = l.pos
join f on f.lang is not distinct from l.lang and f.pos = l.pos and f.i = coalesce(p.last, 0)""",
    }
