"""The operators of this subpackage as named queries over whole tables, with SQL where SQL can express the result."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import configure

from . import (
    certified_packing,
    collision_ann,
    language_mixture,
    license_fuzzy,
    link_trust,
    merkle_manifest,
    piece_encode,
    prefix_trie,
    secret_forest,
    simhash_mih,
    token_store,
    warc_chunks,
    weak_rules,
)
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_language_mixture(spark, sf_dir):
    return language_mixture.identify(table(spark, sf_dir, "documents"))


@query
def op2_link_trust(spark, sf_dir):
    return link_trust.judge(table(spark, sf_dir, "pages"))


@query
def op3_license_fuzzy(spark, sf_dir):
    return license_fuzzy.scan(table(spark, sf_dir, "documents"))


@query
def op4_certified_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return certified_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))[0]


@query
def op5_piece_encode(spark, sf_dir):
    return piece_encode.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_secret_forest(spark, sf_dir):
    return secret_forest.scan(table(spark, sf_dir, "documents"))


@query
def op7_simhash_near_dedup(spark, sf_dir):
    return simhash_mih.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_collision_ann(spark, sf_dir):
    return collision_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_weak_quality_rules(spark, sf_dir):
    return weak_rules.judge(table(spark, sf_dir, "documents"))


@query
def op10_warc_chunks(spark, sf_dir):
    return warc_chunks.round_trip(table(spark, sf_dir, "pages"))


@query
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return merkle_manifest.manifest(docs, changed={"text": merkle_manifest.lower_where_crc_divides("doc_id", "text")})


@query
def op12_token_parquet(spark, sf_dir):
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op10_warc_chunks"] = """
    with p as (select page_id, coalesce(html, '') as body from pages),
    d as (select page_id, octet_length(encode(body)) as n, sha1(body) as h from p),
    g as (
        select page_id, n, h, min(page_id) over (partition by h, n) as first_id,
            row_number() over (partition by h, n order by page_id) as copy
        from d
    )
    select page_id, cast(n as bigint) as payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as int), 5) as bigint) >> cast(15 - 5 * (i % 4) as int)) & 31) as int), 1)), '')
            as payload_digest,
        case when copy = 1 then 'response' else 'revisit' end as record_type,
        case when copy = 1 then null else first_id end as refers_to
    from g
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, byte by byte and bit by bit."""
    bit = "list_reduce(list_prepend({x}, [0, 1, 2, 3, 4, 5, 6, 7]), lambda c, _: xor(c >> 1, (c & 1) * 3988292384))"
    step = bit.format(x="xor(s, b)")
    codes = f"list_transform(string_split({text}, ''), lambda ch: cast(ascii(ch) as bigint))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), lambda s, b: {step}), 4294967295)"


def _tree_sql(source: str, name: str, by: str, levels: int) -> str:
    """Nodes of ``source`` (``{by}, p, n, h``) level by level as ``{name}0`` and on, with the siblings of each in its run; the
    next level's node is the hash of a run, and a tree of one node stays as it is. ``levels`` covers 16^levels nodes."""
    out = []
    for k in range(levels):
        run = f"partition by {by}, p // 16 order by p rows between"
        out.append(f"""
    {name}{k} as (
        select *, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
            coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r
        from {source}
    ),
    {name}_up{k} as (
        select {by}, p // 16 as p, case when n = 1 then min(h) else sha256(string_agg(h, '' order by p)) end as h, (n + 15) // 16 as n
        from {source} group by {by}, p // 16, n
    ),""")
        source = f"{name}_up{k}"
    return "".join(out)


def _manifest_sql(levels: int = 5, group_levels: int = 3) -> str:
    def part(c: str) -> str:
        return f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || cast({c} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [("t", k, "d.tree") for k in range(levels)] + [("g", k, "''") for k in range(group_levels)]
    joins = "".join(
        f" join {n}{k} {n}_{k} on {n}_{k}.tree = {tree} and {n}_{k}.p = {'d.p' if n == 't' else 'm.p'} // {16**k}" for n, k, tree in steps[:levels]
    ) + " join groups m on m.member = d.tree" + "".join(
        f" join {n}{k} {n}_{k} on {n}_{k}.tree = {tree} and {n}_{k}.p = m.p // {16**k}" for n, k, tree in steps[levels:]
    )
    proof = " || ".join(f"case when {n}_{k}.n > 1 then {n}_{k}.l || {n}_{k}.r else '' end" for n, k, _ in steps)
    folds, at = [], "later"
    for i, (n, k, _) in enumerate(steps):
        folds.append(f"folded{i} as (select *, case when n{i} > 1 then sha256(l{i} || {at} || r{i}) else {at} end as f{i} from {f'folded{i - 1}' if i else 'paths'})")
        at = f"f{i}"
    sides = ", ".join(f"{n}_{k}.n as n{i}, {n}_{k}.l as l{i}, {n}_{k}.r as r{i}" for i, (n, k, _) in enumerate(steps))
    return f"""
    with docs as (
        select *, case when source is null then '' else '=' || source end as tree,
            case when {_crc32("cast(doc_id as varchar)")} % 5 = 0 then {lowered} else text end as later_text
        from documents
    ),
    d as (
        select doc_id, tree, {leaf("text")} as h, {leaf("later_text")} as later,
            row_number() over (partition by tree order by doc_id) - 1 as p, count(*) over (partition by tree) as n
        from docs
    ),
    leaves as (select tree, p, n, h from d),{_tree_sql("leaves", "t", "tree", levels)}
    groups as (
        select '' as tree, tree as member, h, row_number() over (order by encode(tree)) - 1 as p, count(*) over () as n
        from t_up{levels - 1}
    ),{_tree_sql("groups", "g", "tree", group_levels)}
    paths as (
        select d.doc_id, d.h as leaf, d.later, m.h as subroot, (select h from g_up{group_levels - 1}) as root,
            sha256({proof}) as proof_sha256, {sides}
        from d{joins}
    ),
    {", ".join(folds)}
    select doc_id, leaf, subroot, root, proof_sha256, {at} as folded_root, {at} = root as verified from folded{len(steps) - 1}
    """


ORACLES["op11_merkle_manifest"] = _manifest_sql()
ORACLES["op13_prefix_trie"] = f"""
    with t as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as p
        from conversations where conv_id is not null
    ),
    c as (
        select conv_id, conv_id - conv_id % 5 as base, {_crc32("cast(conv_id as varchar)")} % 9 as h
        from (select distinct conv_id from t)
    ),
    r as (
        select c.conv_id, t.p, t.role, t.text from c join t on t.conv_id = c.conv_id where t.p >= c.h
        union all
        select c.conv_id, t.p, t.role, t.text from c join t on t.conv_id = c.base where t.p < c.h
    ),
    s as (
        select conv_id, row_number() over (partition by conv_id order by p) as d, octet_length(encode(text)) as size,
            sha256(octet_length(encode(role)) || ':' || role || text) as x
        from r
    ),
    k as (
        select conv_id, d, size, sha256(string_agg(x, '') over (partition by conv_id order by d)) as key from s
        union all
        select conv_id, 0, 0, 'root' from c
    ),
    n as (select key, d, min(conv_id) as id, count(*) as n_convs, any_value(size) as size from k group by key, d),
    e as (
        select key, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256
        from (select * from k qualify d = max(d) over (partition by conv_id)) group by key
    ),
    p as (select n.*, q.key as up from n left join k q on q.conv_id = n.id and q.d = n.d - 1),
    kids as (select up, count(*) as n_children from p where d > 0 group by up),
    f as (
        select p.*, u.id as up_id, coalesce(kids.n_children, 0) as n_children
        from p left join n u on u.key = p.up left join kids on kids.up = p.key
    ),
    sums as (
        select k.key, count(*) filter (where f.n_children = 0) as n_leaves, cast(sum((f.n_convs - 1) * f.size) as bigint) as saved_tokens
        from f join k on k.conv_id = f.id and k.d <= f.d group by k.key
    )
    select f.id as conv_id, f.d as depth, f.up_id as parent_conv_id, f.n_convs, f.n_children, sums.n_leaves, sums.saved_tokens,
        coalesce(e.ends_sha256, sha256('')) as ends_sha256
    from f join sums using (key) left join e using (key)
    """
