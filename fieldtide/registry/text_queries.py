"""Text cleaning and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtide.adapters import Tables
from fieldtide.functions import fixed_values as fixed
from fieldtide.functions import text as tx
from fieldtide.operators import reviews as rv
from fieldtide.operators import text as tt
from fieldtide.plans.reviews import review_job
from fieldtide.registry.core import query
from fieldtide.session import scratch_path


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')"


def map_sql(mapping: dict[str, str]) -> str:
    return "map {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in mapping.items()) + "}"


def mapped_sql(words: str, mapping: dict[str, str]) -> str:
    return f"array_to_string(list_transform({words}, lambda w: coalesce({map_sql(mapping)}[lower(w)], w)), ' ')"


def printable_sql(c: str) -> str:
    return f"regexp_replace({c}, '{fixed.NON_PRINTABLE}', '', 'g')"


def urls_sql(c: str) -> str:
    return f"regexp_replace({c}, '{fixed.URL_PATTERN}', 'URLLINK', 'g')"


def phrases_sql(c: str) -> str:
    for phrase in fixed.JUNK_PHRASES:
        c = f"replace({c}, {quoted(phrase)}, ' ')"
    return c


def expand_sql(c: str) -> str:
    return mapped_sql(words_sql(c), fixed.CONTRACTIONS)


def clean_sql(c: str) -> str:
    c = phrases_sql(urls_sql(expand_sql(printable_sql(c))))
    for old, new in fixed.REWRITES:
        c = f"replace({c}, {quoted(old)}, {quoted(new)})"
    return c


def _text(t: Tables, column, name: str):
    return t.fx("fx_text").select("doc_id", column(F.col("text")).alias(name))


@query("remove_non_printable", f"select doc_id, {printable_sql('text')} cleaned from fx_text", views=["fx_text"])
def printable(t):
    return _text(t, tx.remove_non_printable, "cleaned")


@query("expand_contractions", f"select doc_id, {expand_sql('text')} cleaned from fx_text", views=["fx_text"])
def expand(t):
    return _text(t, tx.expand_contractions, "cleaned")


@query("replace_urls", f"select page_id, {urls_sql('url')} url from pages union all select doc_id, {urls_sql('text')} from fx_text", views=["fx_text"])
def urls(t):
    pages = t.table("pages").select("page_id", tx.replace_urls(F.col("url")).alias("url"))
    return pages.union(_text(t, tx.replace_urls, "url"))


@query("drop_phrases", f"select doc_id, {phrases_sql('text')} cleaned from fx_text", views=["fx_text"])
def phrases(t):
    return _text(t, tx.drop_phrases, "cleaned")


@query("clean_text", f"select doc_id, {clean_sql('text')} cleaned from fx_text", views=["fx_text"])
def clean(t):
    return _text(t, tx.clean_text, "cleaned")


LEMMA_SQL = """case when length(w) < 4 or regexp_matches(w, '(ss|us|is)$') then w
 when regexp_matches(w, '[^aeiou]ies$') then regexp_replace(w, 'ies$', 'y')
 when regexp_matches(w, '(ss|x|z|ch|sh)es$') then regexp_replace(w, 'es$', '')
 when regexp_matches(w, '[lr]ves$') then regexp_replace(w, 'ves$', 'f')
 when regexp_matches(w, 'men$') then regexp_replace(w, 'men$', 'man') else regexp_replace(w, 's$', '') end"""


def detached_sql(w: str) -> str:
    tried = [f"case when ends_with({w}, '{e}') and length({w}) >= 4" + (f" and not regexp_matches({w}, '(ss|us|is)$')" if e == "s" else "")
             + f" then left({w}, length({w}) - {len(e)}) || '{b}' end" for e, b in fixed.NOUN_RULES]
    return f"[{', '.join(tried)}]"


FORMS_SQL = f"""forms as (select distinct unnest({words_sql('text')}) w from fx_text),
tried as (select w, unnest({detached_sql('w')}) c, unnest(range({len(fixed.NOUN_RULES)})) rule from forms),
known as (select w, arg_min(c, {{'n': length(c), 'rule': rule}}) c from tried where c in (select w from forms) group by 1),
lemma as (select w, coalesce({map_sql(fixed.IRREGULAR_NOUNS)}[w], c, {LEMMA_SQL}) l from forms left join known using (w)),
words as (select doc_id, unnest({words_sql('text')}) w, unnest(range(len({words_sql('text')}))) i from fx_text),
made as (select doc_id, string_agg(l, ' ' order by i) made from words join lemma using (w) group by 1)"""


@query("lemmatize", FORMS_SQL + "---select doc_id, case when text is not null then coalesce(made, '') end lemmatized from fx_text left join made using (doc_id)", views=["fx_text"])
def lemmas(t):
    return tt.lemmatize(t.fx("fx_text"), "text").select("doc_id", "lemmatized")


@query("lemmatize_table", f"""select doc_id, array_to_string(list_transform({words_sql('text')}, lambda w: case when w = 'see' then 'look'
 when w = 'wrong,' then 'false' else w end), ' ') lemmatized from fx_text""", views=["fx_text"])
def lemma_table(t):
    # The lemma table comes with the texts' own forms: the tokens of the appended phrases.
    forms = t.fx("fx_text").select(F.explode(tx.tokens(F.col("text"))).alias("form")).where("form in ('see', 'wrong,')").distinct()
    table = forms.withColumn("lemma", F.when(F.col("form") == "see", "look").otherwise("false"))
    return tt.lemmatize(t.fx("fx_text"), "text", table, key="doc_id").select("doc_id", "lemmatized")


@query("stop_word_filter", f"""select doc_id, array_to_string(list_filter({words_sql('text')}, lambda w: lower(w) not in
 ({', '.join(quoted(w) for w in fixed.STOP_NOUNS)})), ' ') kept from fx_text""", views=["fx_text"])
def stop_words(t):
    return _text(t, lambda c: F.array_join(tx.stop_word_filter(tx.tokens(c)), " "), "kept")


@query("standardize_terms", f"select doc_id, {mapped_sql(words_sql('text'), fixed.STANDARD_TERMS)} terms from fx_text", views=["fx_text"])
def terms(t):
    return _text(t, lambda c: F.array_join(tx.standardize_terms(tx.tokens(c)), " "), "terms")


@query("join_list", "select doc_id, array_to_string(string_split(text, ' '), '..') joined from documents")
def joined(t):
    return t.table("documents").select("doc_id", tx.join_list(F.split("text", " "), "..").alias("joined"))


# What goes on after a period gets a mark, then ends are cut, then the marks go.
OPENED_SQL = """(^|[\\s("''])"""


def sentences_sql(text: str, listed: str) -> str:
    """``listed`` is an SQL text of alternatives."""
    marked = f"""regexp_replace({text}, '{OPENED_SQL}((?i:' || {listed} || ')\\.)', '\\1\\2' || chr(2), 'g')"""
    marked = f"""regexp_replace({marked}, '{OPENED_SQL}(\\p{{Lu}}\\.)', '\\1\\2' || chr(2), 'g')"""
    marked = f"""regexp_replace({marked}, '{OPENED_SQL}([0-9]{{1,9}}\\.)(\\s+\\p{{Ll}})', '\\1\\2' || chr(2) || '\\3', 'g')"""
    cut = f"replace(regexp_replace({marked}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(2), '')"
    return f"list_filter(string_split({cut}, chr(1)), lambda s: s <> '')"


LISTED = "'" + "|".join(a.replace(".", "\\.") for a in fixed.ABBREVIATIONS) + "'"


def split_sql(text: str) -> str:
    return sentences_sql(text, LISTED)


def _listed(rows):
    return rows.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.array_join("s", "|").alias("sentences"))


@query("split_sentences", f"select doc_id, len(s) n_sentences, array_to_string(s, '|') sentences from (select doc_id, {split_sql('text')} s from documents) x")
def sentences(t):
    return _listed(t.table("documents").select("doc_id", tx.split_sentences(F.col("text")).alias("s")))


LEARNT_SQL = f"""words as (select unnest({words_sql('text')}) w from documents),
counts as (select lower(case when ends_with(w, '.') then left(w, length(w) - 1) else w end) form, count(*) filter (ends_with(w, '.')) a,
 count(*) filter (not ends_with(w, '.')) b from words group by 1),
total as (select sum(a) p, sum(a + b) n from counts),
scored as (select form, a with_period, b apart, -2.0::double * (a * ln(p / n) + b * ln(1 - p / n) - a * ln(0.99) - b * ln(0.01))
 * exp(-length(replace(form, '.', ''))) * (length(form) - length(replace(form, '.', '')) + 1) * pow(length(replace(form, '.', ''))::double, -b::double) score
 from counts, total where a > 0 and regexp_full_match(form, '\\p{{L}}+(\\.\\p{{L}}+)*')),
learnt as (select * from scored where score >= {tt.ABBREVIATION})"""


@query("learn_abbreviations", LEARNT_SQL + "---select * from learnt", digits={"score": 5})
def abbreviations(t):
    return tt.learn_abbreviations(t.table("documents"), "text")


@query("split_sentences_learnt", LEARNT_SQL + f""", listed as (select coalesce(string_agg(regexp_escape(form), '|'), '$^') f from learnt)
---select doc_id, len(s) n_sentences, array_to_string(s, '|') sentences from (select doc_id, {sentences_sql('text', 'f')} s from documents, listed) x""")
def learnt_sentences(t):
    rows = t.table("documents")
    return _listed(tt.learnt_sentences(rows, "text", tt.learn_abbreviations(rows, "text"), "s"))


def products(t: Tables):
    """Conversations as products with a list of reviews: repeated ids, a few without text."""
    text = F.when(F.col("turn") % 7 != 3, F.col("text"))
    review = F.struct("turn", (F.col("turn") % 4).cast("string").alias("Id"), text.alias("ReviewText"))
    rows = t.table("conversations").groupBy(F.col("conv_id").alias("omsid")).agg(F.array_sort(F.collect_list(review)).alias("_r"))
    plain = F.transform("_r", lambda r: F.struct(r["Id"].alias("Id"), r["ReviewText"].alias("ReviewText")))
    return rows.select("omsid", F.size("_r").cast("long").alias("num_reviews"), plain.alias("reviews"))


@query("explode_reviews", """select conv_id omsid, cast(turn % 4 as varchar) review_id, arg_max(text, turn) review_text
 from conversations where turn % 7 <> 3 group by 1, 2""")
def exploded(t):
    return rv.explode_reviews(products(t))


@query("review_id_text", "select conv_id omsid, cast(turn % 4 as varchar) review_id, case when turn % 7 <> 3 then text end review_text from conversations")
def id_text(t):
    return rv.review_id_text(products(t))


def sides(t: Tables):
    """Reviews with their clean and raw sentences."""
    rows = rv.explode_reviews(products(t))
    return rows.select("omsid", "review_id", tx.split_sentences(tx.clean_text(F.col("review_text"))).alias("q"),
                       tx.split_sentences(F.col("review_text")).alias("raw"))


REVIEWS_SQL = f"""r as (select conv_id omsid, cast(turn % 4 as varchar) review_id, arg_max(text, turn) t from conversations where turn % 7 <> 3 group by 1, 2),
s as (select omsid, review_id, {clean_sql('t')} cleaned, {split_sql(clean_sql('t'))} q, {split_sql('t')} raw from r)"""
# A run of as many words as the clean sentence has, or a shorter raw sentence as a whole.
RUNS_SQL = REVIEWS_SQL + f""",
queries as (select omsid, review_id, raw, unnest(range(1, len(q) + 1)) qi, unnest(q) query from s),
listed as (select omsid, review_id, qi, query, si, {words_sql(printable_sql('raw[si]'))} w, raw[si] sentence, least(len({words_sql('query')}), len({words_sql(printable_sql('raw[si]'))})) n
 from (select *, unnest(range(1, len(raw) + 1)) si from queries) x),
runs as (select omsid, review_id, qi, query, si, sentence, array_to_string(w[i:i + n - 1], ' ') run
 from (select *, unnest(case when n > 0 then range(1, len(w) - n + 2) else [0] end) i from listed) x),
scored as (select omsid, review_id, qi, si, sentence, case when run = '' then 0 else 1.0::double - levenshtein(run, query) / greatest(length(run), length(query)) end score from runs),
matched as (select omsid, review_id, qi, arg_min(sentence, {{'score': -score, 'si': si}}) sentence from scored group by 1, 2, 3),
of_review as (select omsid, review_id, string_agg(sentence, '|' order by qi) matched from matched group by 1, 2)"""


@query("match_sentences", RUNS_SQL + "---select omsid, review_id, coalesce(matched, '') matched from s left join of_review using (omsid, review_id)")
def match(t):
    return sides(t).select("omsid", "review_id", F.array_join(rv.match_sentences(F.col("q"), F.col("raw")), "|").alias("matched"))


@query("match_sentences_by_ratio")
def match_by_ratio(t):
    return sides(t).select("omsid", "review_id", F.array_join(rv.match_sentences_by_ratio(F.col("q"), F.col("raw")), "|").alias("matched"))


MATCH_SQL = f"""r as (select conv_id omsid, cast(turn % 4 as varchar) review_id, arg_max(text, turn) t from conversations where turn % 7 <> 3 group by 1, 2),
s as (select omsid, review_id, {split_sql(clean_sql('t'))} q, {split_sql('t')} raw from r),
pairs as (select omsid, review_id, qi, raw[si] sentence, levenshtein(q[qi], {printable_sql('raw[si]')}) edits, si
 from (select *, unnest(range(1, len(raw) + 1)) si from (select *, unnest(range(1, len(q) + 1)) qi from s) a) b),
best as (select omsid, review_id, qi, arg_min(sentence, edits * 1000000 + si) sentence from pairs group by 1, 2, 3)
---select s.omsid, s.review_id, coalesce(string_agg(sentence, '|' order by qi), '') matched from s left join best using (omsid, review_id) group by 1, 2"""


@query("match_sentences_by_edits", MATCH_SQL)
def match_by_edits(t):
    return sides(t).select("omsid", "review_id", F.array_join(rv.match_sentences_by_edits(F.col("q"), F.col("raw")), "|").alias("matched"))


REVIEW_SQL = RUNS_SQL + """---select omsid, review_id, cleaned review_text_cleaned, array_to_string(q, '|') sentences_cleaned,
 case when rtrim(cleaned) <> '' then coalesce(matched, '') end sentences_raw from s left join of_review using (omsid, review_id)"""


@query("review_sentences", REVIEW_SQL)
def review(t):
    return _reviewed(rv.review_sentences(products(t)))


def _reviewed(rows):
    return rows.select("omsid", "review_id", "review_text_cleaned", F.array_join("sentences_cleaned", "|").alias("sentences_cleaned"),
                       F.array_join("sentences_raw", "|").alias("sentences_raw"))


@query("review_job", REVIEW_SQL)
def review_run(t):
    """Two run folders; the newest holds the reviews and is the one that is processed."""
    folder, out = scratch_path(t.spark, "review-runs"), scratch_path(t.spark, "reviews-out")
    rows = products(t)
    old = rows.where("omsid < 5").withColumn("run_date", F.lit("20240105_hd_reviews"))
    new = rows.withColumn("run_date", F.lit("20240205_hd_reviews"))
    old.unionByName(new).write.partitionBy("run_date").json(folder)
    return _reviewed(review_job(t.spark, folder, out))
