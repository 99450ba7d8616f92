"""One query per operator over its whole table, with the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.llm import chat, classifier, decontamination, license_scan, line_dedup, mixing, near_dedup, pii, prefix_trie, quality_rules, sharding, structure_repair, warc
from fieldtide.llm.common import scratch, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CONTROL = "<|im_end|><|im_start|>assistant ok"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_template_leaks")
def template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that leak a benchmark item: doc_id, item_id, windows of the item, windows found, changed slots."""
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("row")


def license_sql() -> str:
    known = ", ".join(f"('{s}', '{name}')" for name, s in license_scan.SENTENCES.items())
    rules = ", ".join(f"({i}, '{lic}', '{kind}', ' {' '.join(ids)} ')" for i, (lic, kind, ids) in enumerate(license_scan.RULES))
    return rf"""
with known(sentence, sid) as (values {known}), rules(place, licence, kind, ids) as (values {rules}),
raw as (select doc_id, unnest(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), '\n')) s,
 generate_subscripts(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), '\n'), 1) i from documents),
clean as (select doc_id, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) s from raw),
ids as (select doc_id, i, sid from clean left join known on s = sentence where s <> ''),
lines as (select doc_id, count(*) n, ' ' || string_agg(coalesce(sid, '_'), ' ' order by i) || ' ' line, coalesce(string_agg(sid, ' ' order by i), '') found from ids group by 1),
hits as (select doc_id, licence, min(place) place, min(case kind when 'reserved' then 0 when 'noncommercial' then 1 when 'copyleft' then 2 else 3 end) strict
 from lines join rules on contains(line, ids) group by 1, 2),
named as (select doc_id, string_agg(licence, ' ' order by place) licenses, min(strict) strict from hits group by 1)
select d.doc_id, coalesce(n, 0) n_sentences, coalesce(found, '') sentence_ids, coalesce(licenses, '') licenses,
 case strict when 0 then 'reserved' when 1 then 'noncommercial' when 2 then 'copyleft' when 3 then 'permissive' else 'none' end category
from documents d left join lines using (doc_id) left join named using (doc_id)"""


@query("op2_license_sentences", license_sql())
def license_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


@query("op3_setsketch_dedup")
def setsketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), percent=85).drop("text_hash")


GAP_SQL = r"'[\x20\x09-\x0D]+'"
LEAST_SQL = "case " + " ".join(f"when {{n}} >= {n} then {docs}" for n, docs in line_dedup.MIN_DOCS) + " end"
TEMPLATE_SQL = f"""
with texts as (select distinct text from documents where text is not null),
pieces as (select text, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) i from texts),
lines as (select text, i, list_transform(list_filter(regexp_split_to_array(line, {GAP_SQL}), lambda w: w <> ''),
 lambda w: case when regexp_matches(w, '[0-9]') then '<*>' else w end) k from pieces),
leafed as (select text, i, k, {{'n': len(k), 'head': k[1:{line_dedup.DEPTH}]}} leaf from lines where len(k) > 0),
busy as (select leaf, count(distinct k) forms from leafed group by 1 having count(*) >= {LEAST_SQL.format(n='leaf.n')}),
forms as (select distinct leaf, k from leafed join busy using (leaf) where forms > 1),
counts as (select leaf, place, k[place] token, count(*) c from (select leaf, k, unnest(range(1, len(k) + 1)) place from forms) x group by 1, 2, 3),
constant as (select leaf, place, (max({{'c': c, 't': token}})).t token from counts join busy using (leaf)
 group by 1, 2, forms having max(c) >= forms * {line_dedup.CONSTANT}),
near as (select leaf, k from (select leaf, k, unnest(range(1, len(k) + 1)) place from forms) x join constant using (leaf, place)
 where k[place] = token group by 1, 2 having count(*) >= len(k) * {line_dedup.SIMILAR}),
members as (select l.text, l.i, l.leaf, case when near.leaf is null then l.k end own from leafed l semi join busy using (leaf) left join near on near.leaf = l.leaf and near.k = l.k),
recurring as (select leaf, own from members group by 1, 2 having count(distinct text) >= {LEAST_SQL.format(n='leaf.n')}),
gone as (select distinct m.text, m.i from members m join recurring r on m.leaf = r.leaf and m.own is not distinct from r.own),
kept as (select p.text, count(gone.text) dropped, count(*) n, coalesce(string_agg(p.line, chr(10) order by p.i) filter (gone.text is null), '') rest
 from pieces p left join gone on gone.text = p.text and gone.i = p.i group by 1)
select doc_id, coalesce(n, 0) n_lines, coalesce(dropped, 0) n_dropped, length(rest) kept_chars, sha256(rest) kept_sha256
from documents d left join kept on kept.text = d.text"""


@query("op4_template_lines", TEMPLATE_SQL)
def template_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and dropped lines per document, with a digest of what is left of the text."""
    out = line_dedup.drop_recurring_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


@query("op5_pivotal_mix")
def pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op6_byte_cnn")
def byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    out = classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", classifier.held_out().alias("held_out"), "score", "predicted")


WARC_SQL = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) n, sha1(coalesce(html, '')) d from pages),
r as (select page_id, n, d, case when n >= {warc.LEAST_BYTES} then max(page_id) over (partition by d, n >= {warc.LEAST_BYTES}) else page_id end f from p)
select page_id, n::bigint payload_bytes, d payload_digest, case when f = page_id then 'response' else 'revisit' end record_type,
 case when f <> page_id then f end refers_to from r"""


@query("op7_splittable_warc", WARC_SQL)
def splittable_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = warc.write_warc(table(spark, folder, "pages"), scratch(spark, "warc"))
    return warc.page_records(warc.read_warc(files))


CHAT_SQL = rf"""
with turns as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
 union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}'),
marked as (select *, lag(r) over w is not distinct from r and row_number() over w > 1 joined,
 length(replace(replace(t, '\', '\\'), '<|', '<\|')) body, length(replace(replace(replace(r, '\', '\\'), '<|', '<\|'), chr(10), '\n')) head
 from turns window w as (partition by conv_id order by turn, r, t))
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) turns_sha256,
 coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint loss_chars,
 sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) loss_sha256,
 sum(body + case when joined then 11 else 12 + head + 1 + 11 end)::bigint formatted_chars
from marked group by 1"""


@query("op8_relational_chat", CHAT_SQL)
def relational_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Format all conversations and one of control strings, store the result, and read turns and loss back from it."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], turns.schema)
    chats = chat.parse_chats(stored(chat.format_chats(turns.unionByName(extra)), "chats"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def outlier_sql() -> str:
    """The base columns, then the concentration steps unrolled."""
    q = quality_rules
    words = f"list_filter(regexp_split_to_array(coalesce(text, ''), {GAP_SQL}), lambda w: w <> '')"
    low = [(i, j) for i in range(4) for j in range(i + 1)]
    z: list[str] = []
    for i in range(4):
        rest = f"f{i} - m{i}"
        for j in range(i):
            rest += f" - l{i}{j} * {z[j]}"
        z.append(f"(({rest}) / l{i}{i})")
    distance = " + ".join(f"{x} * {x}" for x in z)
    parts = [rf"""ws as (select row_number() over () r, doc_id, lang, source, text, {words} w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) ln from documents)""",
             """win as (select r, i, [w[i], w[i + 1], w[i + 2]] k from (select r, w, unnest(range(1, len(w) - 1)) i from ws) x)""",
             """rep as (select r, count(distinct p) n from (select r, unnest([i, i + 1, i + 2]) p from
  (select r, i, count(*) over (partition by r, k) c from win) y where c > 1) x group by 1)""",
             """base as (select r, doc_id, lang, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::bigint n_symbols, (len(ln) - len(list_distinct(ln)))::bigint n_dup_lines,
  coalesce(n, 0)::bigint n_repeat_words, len(ln) n_lines from ws left join rep using (r))""",
             f"""rows_ as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, {{'l': lang, 's': source}} grp,
  round(ln(1 + word_chars / greatest(n_words, 1)) * {q.UNIT})::bigint f0, round(ln(1 + 10 * n_symbols / greatest(n_words, 1)) * {q.UNIT})::bigint f1,
  round(n_dup_lines / greatest(n_lines, 1) * {q.UNIT})::bigint f2, round(n_repeat_words / greatest(n_words, 1) * {q.UNIT})::bigint f3 from base)""",
             f"sizes as (select grp, count(*) >= {q.MIN_ROWS} big from rows_ where not base_failed group by 1)",
             """good as (select grp::varchar fit, f0, f1, f2, f3 from rows_ join sizes using (grp) where big and not base_failed
  union all select '', f0, f1, f2, f3 from rows_ where not base_failed)"""]
    start = [f"quantile_cont(f{i}, 0.5) m{i}" for i in range(4)] + [f"{float(2 * q.FLOOR[i]) if i == j else 0.0}::double l{i}{j}" for i, j in low]
    parts.append(f"est0 as (select fit, {', '.join(start)} from good group by 1)")
    for step in range(q.STEPS):
        parts.append(f"at{step} as materialized (select fit, f0, f1, f2, f3, floor(ln(1 + {distance}) * 64) k from good join est{step} using (fit))")
        sums = ["count(*) n"] + [f"sum(f{i})::double s{i}" for i in range(4)] + [f"sum(f{i} * f{j})::double q{i}{j}" for i, j in low]
        parts.append(f"sum{step} as (select fit, {', '.join(sums)} from at{step} join (select fit, quantile_cont(k, {q.SHARE}) cut from at{step} group by 1) c using (fit) where k <= cut group by 1)")
        parts.append(f"mean{step} as (select *, {', '.join(f's{i} / n m{i}' for i in range(4))} from sum{step})")
        source = f"mean{step}"
        for i, j in low:
            value = f"(q{i}{j} / n - m{i} * m{j}) * {q.CONSISTENCY}" + (f" + {float(q.FLOOR[i] ** 2)}::double" if i == j else " + 0.0::double")
            for k in range(j):
                value = f"{value} - l{i}{k} * l{j}{k}"
            cell = f"sqrt(greatest({value}, 1.0::double))" if i == j else f"({value}) / l{j}{j}"
            parts.append(f"c{step}_{i}{j} as (select *, {cell} l{i}{j} from {source})")
            source = f"c{step}_{i}{j}"
        parts.append(f"est{step + 1} as materialized (select fit, {', '.join(f'm{i}' for i in range(4))}, {', '.join(f'l{i}{j}' for i, j in low)} from {source})")
    return "with " + ",\n".join(parts) + f"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not base_failed and coalesce({distance} <= {q.CUT}, true) kept, round({distance}, 3) distance
from rows_ left join sizes using (grp) left join est{q.STEPS} on fit = case when big then grp::varchar when big is not null then '' end"""


@query("op9_robust_outliers", outlier_sql())
def robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, folder, "documents"))
    return out.withColumn("distance", F.round("distance", 3))


@query("op10_virtual_slots")
def virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    out = sharding.shard(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                      "virtual_slot", "map_version")


# The patterns as they stand in the contract, and the proposals of the added kinds.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii_sql() -> str:
    """Every kind by its pattern; starts are summed from the pieces between the matches."""
    luhn = """list_sum(list_transform(range(1, length(d) + 1), lambda j: case when (length(d) - j) % 2 = 1
 then case when d[j]::int > 4 then 2 * d[j]::int - 9 else 2 * d[j]::int end else d[j]::int end)) % 10 = 0"""
    mod97 = f"""list_reduce(list_prepend(0, list_transform(regexp_extract_all(replace(v, ' ', '')[5:] || replace(v, ' ', '')[:4], '.'),
 lambda c: instr('{pii.SYMBOLS}', c) - 1)), lambda n, x: (n * (case when x > 9 then 100 else 10 end) + x) % 97) = 1"""
    right = {
        "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda o: coalesce(try_cast(o as hugeint) <= 255, false)))",
        "card": f"case when length(d) between 12 and 19 then {luhn} else false end",
        "phone": "length(d) between 9 and 15",
        "iban": f"coalesce({mod97}, false)",
        "ssn": "v[:3] not in ('000', '666') and v[:3] < '900' and v[5:6] <> '00' and v[8:] <> '0000'",
        "birth": "least(a, b) between 1 and 12 and greatest(a, b) between 1 and 31",
    }
    near = "regexp_split_to_array(translate(right(p[i], {}) || ' ' || left(aft, {}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z]+')".format(pii.BEFORE, pii.AFTER)
    parts = []
    for place, kind in enumerate(pii.KINDS):
        pattern = PII_PATTERNS.get(kind.name, kind.pattern)
        listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
        score = f"{kind.score} + case when list_has_any(near, {listed(kind.words)}) then {pii.GAIN} else 0 end"
        score += f" - case when list_has_any(near, {listed(kind.against)}) then {pii.GAIN} else 0 end" if kind.against else ""
        where = right.get(kind.name, "true")
        if kind.alone:
            where += " and not regexp_matches(right(p[i], 1), '[A-Za-z0-9-]') and not regexp_matches(left(aft, 1), '[A-Za-z0-9-]')"
        if not kind.base:
            where += f" and round({score}, 2) >= {pii.LEAST}"
        parts.append(f"""select doc_id, '{kind.name}' kind, {place} place, {str(kind.base).lower()} base, s, s + length(v) e from (
 select *, {near} near, regexp_replace(v, '[^0-9]', '', 'g') d, try_cast(regexp_extract(v, '^([0-9]+)', 1) as int) a,
  try_cast(regexp_extract(v, '^[0-9]+.([0-9]+)', 1) as int) b from (
 select *, m[i] v, p[i + 1] aft,
  coalesce(list_sum(list_transform(p[:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) s
 from (select *, unnest(range(1, len(m) + 1)) i from (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') m, regexp_split_to_array(coalesce(text, ''), '{pattern}') p from documents) x) y) z) w where {where}""")
    return "with spans as (" + "\nunion all ".join(parts) + """),
listed as (select doc_id, count(*) filter (kind = 'email') n_email, count(*) filter (kind = 'ip') n_ip, count(*) filter (kind = 'card') n_card,
 count(*) filter (kind = 'phone') n_phone, string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, place) filter (base) based,
 string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, place) spans from spans group by 1)
select doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card, coalesce(n_phone, 0) n_phone,
 sha256(coalesce(based, '')) base_sha256, coalesce(spans, '') spans from documents left join listed using (doc_id)"""


@query("op11_context_pii", pii_sql())
def context_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the four base kinds, a digest of their spans, and all spans of a text."""
    found = pii.find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    base = [k.name for k in pii.KINDS if k.base]
    only = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(only([k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(pii.listed(only(base)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.listed(F.col("spans")).alias("spans"))


GROUP, HEADS = 100, 6  # conversation c starts with up to HEADS - 1 turns of conversation c - c % GROUP


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, lengths) of the rebuilt conversations: first turns of the group's first conversation, then the own rest."""
    own = stored(prefix_trie.steps(conversations), "trie-turns")
    lengths = own.groupBy("conv").agg(F.max("pos").alias("n"))
    head = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % HEADS
    convs = lengths.select("conv", "n", head.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    bases = lengths.where(F.col("conv") % GROUP == 0).select(F.col("conv").alias("base"), F.least("n", F.lit(HEADS - 1)).alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("b", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    convs = stored(convs.withColumn("rest", F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "trie-lengths")
    # A conversation meets its own row once per segment, so one of any length is spread.
    part = F.floor(F.col("pos") / prefix_trie.SEGMENT)
    spread = convs.where("rest > 0").select("conv", "h", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / prefix_trie.SEGMENT))).alias("part"))
    kept = own.withColumn("part", part).join(spread, ["conv", "part"]).where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("b"))
    first = own.where((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "base")
    taken = convs.where("b > 0").select("conv", "base", "b").join(first, "base").where("pos <= b")
    columns = ["conv", "pos", "s1", "s2", "size"]
    return stored(kept.select(columns).unionByName(taken.select(columns)), "trie-paths"), convs.select("conv", (F.col("b") + F.col("rest")).alias("n"))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = f"list_prepend(4294967295, flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(({text})[i])::bigint, 0, 0, 0, 0, 0, 0, 0])))"
    return f"xor(list_reduce({bits}, lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)"


TRIE_SQL = f"""
with t as (select conv_id c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos,
 coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
convs as (select c, n, {crc32_sql('c::varchar')} % {HEADS} h, c - c % {GROUP} base from (select c, count(*) n from t group by 1) x),
paths as (select a.c, t.pos, r, x from convs a join t on t.c = a.base and t.pos <= a.h
 union all select t.c, t.pos - a.h + least(a.h, coalesce(b.n, 0)), r, x from t join convs a on a.c = t.c left join convs b on b.c = a.base where t.pos > a.h),
steps as (select c, pos, length(x) size, string_agg(md5(r || chr(10) || x), '' order by pos) over (partition by c order by pos) k from paths
 union all select c, 0, 0, '' from convs),
rows_ as (select c, pos, size, case when pos = 0 then '' else md5(k) end k, case when pos = 1 then '' when pos > 1 then md5(k[:-33]) end p,
 pos = max(pos) over (partition by c) last from steps),
nodes as (select k, any_value(p) p, any_value(pos) depth, any_value(size) size, count(*) n_convs, min(c) least, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (last), '')) ends from rows_ group by 1),
kids as (select p k, count(*) n from nodes where depth > 0 group by 1),
every as (select nodes.*, coalesce(kids.n, 0) n_children from nodes left join kids using (k)),
sums as (select a.k, sum(case when u.n_children = 0 then 1 else 0 end)::bigint n_leaves, sum((u.n_convs - 1) * u.size)::bigint saved
 from every u join rows_ a on a.c = u.least and a.pos <= u.depth group by 1)
select e.least conv_id, e.depth, up.least parent_conv_id, e.n_convs, e.n_children, n_leaves, saved saved_tokens, e.ends ends_sha256
from every e join sums using (k) left join nodes up on up.k = e.p"""


@query("op12_prefix_trie", TRIE_SQL)
def prefix_trie_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(*rebuilt(table(spark, folder, "conversations")))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with one of 20 fates each, told by the CRC-32 of ``conv_id:turn``: five of them do damage."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def repair_sql() -> str:
    """The same repair by a walk over the rows: cheapest audit per place of the pattern after each row."""
    moves = [(role, p, q) for role, to in structure_repair.MOVES.items() for p, q in to.items()]
    keeps = ", ".join(f"('{r}', {p}, {q})" for r, p, q in moves)
    inserts = ", ".join(f"({p}, {q}, {cost}, '{'I' * n}')" for p, q, cost, n in
                        [(p, q, cell[0], len(cell[1])) for p, row in enumerate(structure_repair.CLOSURE) for q, cell in enumerate(row) if cell])
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    return rf"""
with recursive fated as (select coalesce(conv_id::varchar, ' ') c, turn, coalesce(role, ' ') r, coalesce(text, ' ') x, {crc32_sql(key)} % 20 fate from conversations),
hurt as (select c, turn, case when fate = 4 then 'user' else r end r, case fate when 1 then '' when 2 then regexp_replace(x, '[.!?]', '', 'g') else x end x,
 unnest(range(case when fate = 3 then 2 else 1 end)) again from fated where fate <> 0),
placed as (select c, turn, r, x, row_number() over (partition by c order by turn nulls first, r, x) pos from hurt),
faulty as (select *, case when not regexp_matches(x, '[^\x20\x09-\x0D]') then 'blank' when row_number() over (partition by c, r, x order by pos) > 1 then 'duplicate'
 when not regexp_matches(x, '[.!?][\x20\x09-\x0D]*$') then 'truncated' end fault, lag(r[1]) over (partition by c order by pos) || r[1] pair from placed),
counts as (select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps, count(*) filter (fault = 'blank') blank,
 count(*) filter (fault = 'duplicate') duplicate, count(*) filter (fault = 'truncated') truncated, count(*) filter (pair not in ('su', 'ua', 'au')) illegal,
 max(pos) n from faulty group by 1),
keeps(role, p, q) as (values {keeps}), inserts(p, q, cost, letters) as (values {inserts}),
edits as (select c, pos, p, q, min({{'cost': cost + case when fault = 'truncated' and letter <> 'D' then 5 else 0 end, 'letter': letter}}) e from (
 select c, pos, fault, p, p q, 2 cost, 'D' letter from faulty, range(4) t(p)
 union all select c, pos, fault, p, q, 0, 'K' from faulty join keeps on role = r[1] where fault is null or fault = 'truncated'
 union all select c, pos, fault, p, q, 1, 'R' from faulty, keeps where role <> 's' and (fault is null or fault = 'truncated')) a group by 1, 2, 3, 4),
walk as (select c, 0::bigint pos, q place, cost::bigint cost, letters audit from counts, inserts where p = 0
 union all select c, pos, place, b.cost, b.audit from (select w.c, w.pos + 1 pos, i.q place,
  min({{'cost': w.cost + e.e.cost + i.cost, 'audit': w.audit || e.e.letter || i.letters}}) b
  from walk w join edits e on e.c = w.c and e.pos = w.pos + 1 and e.p = w.place join inserts i on i.p = e.q group by 1, 2, 3) s),
best as (select w.c, min({{'cost': cost, 'audit': audit}}) b from walk w join counts k on k.c = w.c and k.n = w.pos where place in (0, 3) group by 1),
letters as (select c, b.audit[i] letter, i from (select c, b, unnest(range(1, length(b.audit) + 1)) i from best) x),
outs as (select *, sum(case when letter <> 'I' then 1 else 0 end) over w pos, sum(case when letter <> 'D' then 1 else 0 end) over w k
 from letters window w as (partition by c order by i)),
heads as (select o.c, bool_or(f.r[1] = 's') s from outs o join faulty f on f.c = o.c and f.pos = o.pos where k = 1 and letter = 'K' group by 1),
said as (select o.c, string_agg(case when letter = 'K' then f.r || ':' || f.x when (k % 2 = 1) <> coalesce(s, false) then 'user' else 'assistant' end
  || case letter when 'K' then '' when 'R' then ':' || f.x else ':' end, chr(10) order by i) body
 from outs o left join heads using (c) left join faulty f on f.c = o.c and f.pos = o.pos where letter <> 'D' group by 1)
select d.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
 coalesce(illegal, 0) illegal, coalesce(b.cost, 0) cost, coalesce(b.audit, '') audit, sha256(coalesce(body, '')) repaired_sha256
from (select distinct conv_id from conversations) d left join counts k on k.c = coalesce(d.conv_id::varchar, ' ')
 left join best on best.c = k.c left join said on said.c = k.c"""


@query("op13_interval_repair", repair_sql())
def interval_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report = structure_repair.Repair(damaged(turns)).report().withColumnRenamed("conv", "_conv")
    listed = turns.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return listed.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
