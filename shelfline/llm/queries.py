"""One registered query per operator, over whole tables, with production parameters."""

from pyspark.sql import functions as F

from shelfline.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    secrets,
    substring_dedup,
    token_files,
    toxicity,
)
from shelfline.llm.common import table
from shelfline.llm.registry import ORACLES, QUERIES, query  # noqa: F401

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op7_exact_dedup",
    f"""
    with hashed as (select doc_id, sha256({FOLDED}) as text_sha256 from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, text_sha256
    from hashed window same as (partition by text_sha256)
    """,
)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query(
    "op3_line_dedup",
    """
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as position
        from documents),
    keyed as (
        select doc_id, line, position,
               translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from lines),
    firsts as (select key, min(doc_id) as first_doc from keyed where length(key) >= 10 group by key),
    judged as (
        select doc_id, line, position, coalesce(doc_id > first_doc, false) as gone
        from keyed left join firsts using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by position) filter (not gone), '')) as kept_sha256
    from judged group by doc_id
    """,
)
def op3_line_dedup(spark, sf_dir):
    kept = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_secret_scan")
def op10_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op4_bpe_round_trip")
def op4_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), bpe.tokenizer_path(), end_id=2)
    return token_files.read_token_files(manifest)


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return language_id.identify(table(spark, sf_dir, "documents"), held_out=held_out)


@query(
    "op5_jaccard_join",
    """
    with recursive words as (
        select doc_id, list_filter(string_split_regex(lower_ascii, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
        from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz') as lower_ascii from documents)),
    shingles as (
        select distinct doc_id,
               unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as s
        from words),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    links as (
        select a.doc_id as x, b.doc_id as y
        from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
        join sizes m on m.doc_id = a.doc_id join sizes o on o.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, m.n, o.n
        having 100 * count(*) >= 80 * (m.n + o.n - count(*))),
    edges as (select x, y from links union all select y, x from links),
    reach as (
        select doc_id, doc_id as r from documents
        union
        select reach.doc_id, edges.y from reach join edges on edges.x = reach.r)
    select documents.doc_id, coalesce(n, 0) as n_shingles, component_id
    from documents left join sizes using (doc_id)
    join (select doc_id, min(r) as component_id from reach group by doc_id) using (doc_id)
    """,
)
def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    labels = toxicity.chain_labels(table(spark, sf_dir, "labels"))
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return found.withColumn("toxic", F.col("p_toxic") > toxicity.THRESHOLD)


@query("op6_decontaminate")
def op6_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def _license_sql():
    """Every block of every text against every template, by plain list intersection."""
    clean = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    quoted = [(label, " ".join(text.lower().split()).replace("'", "''")) for label, text in license_scan.TEMPLATES]
    templates = ", ".join(f"('{label}', '{text}')" for label, text in quoted)
    phrases = ", ".join(f"('{label}', '{phrase}')" for phrase, label in license_scan.PHRASES.items())
    return f"""
    with words as (
        select doc_id, row_number() over () as r, {clean.format(FOLDED)} as w from documents),
    templates as (
        select label, list_distinct(w) as t, greatest({license_scan.LEAST_CLASS}, pow(2, ceil(log2(len(w))))::bigint) as width
        from (select label, {clean.format('notice')} as w from (values {templates}) v(label, notice))),
    widths as (select distinct width from templates),
    blocks as (
        select r, width, list_distinct(w[i * width + 1 : i * width + 2 * width]) as held
        from (select r, w, width, unnest(range(0, greatest(1, (len(w) - 1) // width))) as i from words, widths)),
    matches as (
        select r, label, len(list_intersect(held, t)) as shared, len(t) as n
        from blocks join templates using (width)),
    found as (
        select r, list(distinct label) as more, max(shared / n) as best
        from matches where 100 * shared >= {license_scan.PERCENT} * n group by r),
    phrases as (select label, string_split(phrase, ' ') as p from (values {phrases}) v(label, phrase)),
    places as (
        select r, label, i from (select r, w, label, p, unnest(range(0, len(w) - len(p) + 1)) as i from words, phrases)
        where w[i + 1 : i + len(p)] = p),
    base as (
        select r, count(*) as n_base, min(i) as first_word, max(i) as last_word, list(distinct label) as labels
        from places group by r)
    select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more, [])))), ','), '') as labels,
           case when n_base > 0 then 1.0 else coalesce(best, 0.0) end as score
    from words left join base using (r) left join found using (r)
    """


@query("op12_license_scan", _license_sql())
def op12_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query(
    "op11_conversation_trie",
    """
    with turns as (
        select conv_id, coalesce(text, '') as text, md5(concat(length(coalesce(role, '')), ':', role, ':', text)) as mark,
               row_number() over (partition by conv_id order by turn nulls first, role, text) as k
        from conversations where conv_id is not null),
    convs as (select distinct conv_id from turns),
    bits as (
        select conv_id, list_concat([4294967295], flatten(list_transform(string_split(conv_id::varchar, ''),
               lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))) as parts from convs),
    heads as (
        select conv_id, xor(list_reduce(parts, lambda crc, part:
               case when part < 0 then xor(crc >> 1, (crc & 1) * 3988292384) else xor(crc, part) end), 4294967295) % 6 as h
        from bits),
    rebuilt as (
        select heads.conv_id, k, mark, text from heads join turns on turns.conv_id = heads.conv_id - heads.conv_id % 100 and k <= h
        union all
        select conv_id, k, mark, text from heads join turns using (conv_id) where k > h),
    paths as (
        select conv_id, coalesce(list(mark order by k) filter (k is not null), []) as marks,
               coalesce(list(length(text) order by k) filter (k is not null), []) as sizes
        from convs left join rebuilt using (conv_id) group by conv_id),
    members as (select conv_id, marks, sizes, unnest(range(0, len(marks) + 1)) as depth from paths),
    nodes as (
        select array_to_string(marks[1 : depth], ' ') as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
               any_value(marks[1 : depth]) as marks, (count(*) - 1) * coalesce(max(sizes[depth]), 0) as own,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = len(marks)), '')) as ends_sha256
        from members group by 1, 2),
    linked as (select *, case when depth > 0 then array_to_string(marks[1 : depth - 1], ' ') end as parent from nodes),
    children as (select parent as node, depth - 1 as depth, count(*) as n_children from linked where depth > 0 group by 1, 2),
    tree as (select linked.*, coalesce(n_children, 0) as n_children from linked left join children using (node, depth)),
    above as (select n_children, own, marks, unnest(range(0, depth + 1)) as up from tree),
    totals as (
        select array_to_string(marks[1 : up], ' ') as node, up as depth, count(*) filter (n_children = 0) as n_leaves, sum(own)::bigint as saved_tokens
        from above group by 1, 2)
    select tree.conv_id, tree.depth, p.conv_id as parent_conv_id, tree.n_convs, tree.n_children, n_leaves, saved_tokens, tree.ends_sha256
    from tree join totals using (node, depth) left join nodes p on p.node = tree.parent and p.depth = tree.depth - 1
    """,
)
def op11_conversation_trie(spark, sf_dir):
    turns = conversation_trie.turns_of(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.shared_heads(turns))


@query(
    "op13_lexical_search",
    f"""
    with docs as (select row_number() over () as r, doc_id, {FOLDED} as t from documents),
    words as (select r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from docs),
    lengths as (select r, doc_id, count(*) as n from words group by r, doc_id),
    sums as (select count(*) as big_n, sum(n)::bigint as big_l from lengths),
    counts as (select r, term, count(*) as tf from words group by r, term),
    weighed as (
        select term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::bigint as w
        from counts, sums group by term),
    items as (select row_number() over () as i, item_id, t from (select distinct item_id, {FOLDED} as t from benchmark)),
    asked as (select distinct i, item_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from items),
    scored as (
        select i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::bigint as score
        from asked join weighed using (term) join counts using (term) join lengths using (r), sums
        group by i, item_id, r, doc_id),
    ranked as (
        select item_id, row_number() over (partition by i order by score desc, doc_id nulls last) as rank, doc_id, score
        from scored where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
    """,
)
def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
