"""DuckDB statements that give the result of each catalogue query."""

from __future__ import annotations

# Named subqueries, each with those it reads.
VIEWS: dict[str, tuple[list[str], str]] = {
    "g": (
        [],
        """
        select concat('/order/', l_orderkey) as subj, concat('/contains/', l_returnflag) as rel,
               concat('/part/', l_partkey) as obj from lineitem
        union all select concat('/order/', o_orderkey), '/placed_by', concat('/customer/', o_custkey) from orders
        union all select concat('/customer/', c_custkey), '/in_nation', concat('/nation/', c_nationkey) from customer
        union all select concat('/nation/', n_nationkey), '/in_region', concat('/region/', n_regionkey) from nation
        union all select concat('/nation/', n_nationkey), '/self', concat('/nation/', n_nationkey) from nation
        union all select concat('/nation/', n_nationkey), '/hub', concat('/region/', n_regionkey) from nation
                  where n_nationkey < 3
        """,
    ),
    "l": (
        ["g"],
        """
        select s as subj, '<http://www.w3.org/2000/01/rdf-schema#label>' as rel, o as obj from (
            select concat('/part/', p_partkey) s, concat('"', p_name, '"@en') o from part
            union all select concat('/part/', p_partkey), concat('"', p_type, '"@en-GB') from part
            union all select concat('/doc/', doc_id), concat('"', text, '"@', lang) from documents
            union all select rel, concat('"', translate(rel, '/_', '  '), '"@en')
                      from (select distinct rel from g where rel <> '/hub'))
        """,
    ),
    "raw": (["g", "l"], "select * from g union all select * from l"),
    "ec": (
        ["g"],
        """
        select ent, count(*)::bigint as "count"
        from (select subj as ent from g union all select obj from g where obj <> subj) group by ent
        """,
    ),
    "rc": (["g"], 'select rel, count(*)::bigint as "count" from g group by rel'),
    "f": (
        ["g", "ec", "rc"],
        """
        select * from g where subj in (select ent from ec where "count" >= 5)
          and obj in (select ent from ec where "count" >= 5) and rel in (select rel from rc where "count" >= 5)
        """,
    ),
    "sp": (
        ["f"],
        """
        select subj, rel, obj,
               case when b < 8000 then 'train' when b < 9000 then 'valid' else 'test' end as split
        from (select *, ('0x' || substr(md5(concat_ws(chr(9), subj, rel, obj)), 1, 8))::bigint % 10000 b from f)
        """,
    ),
    "t": (["sp"], "select subj, rel, obj from sp where split = 'train'"),
    "h": (["sp"], "select subj, rel, obj from sp where split <> 'train'"),
    "ents": (
        ["t"],
        """
        select (row_number() over (partition by p order by substr(md5(ent), 9), ent) - 1)::int as "index", ent,
               p as "partition"
        from (select ent, (('0x' || substr(md5(ent), 1, 8))::bigint % 4)::int p
              from (select subj as ent from t union select obj from t))
        """,
    ),
    "rels": (
        ["t"],
        """
        select (row_number() over (order by substr(md5(rel), 9), rel) - 1)::int as "index", rel as relation
        from (select distinct rel from t)
        """,
    ),
    "coded": (
        ["t", "ents", "rels"],
        """
        select a."index" as subj, b."index" as obj, r."index" as rel, a."partition" as part_left,
               b."partition" as part_right
        from t join ents a on t.subj = a.ent join ents b on t.obj = b.ent join rels r on t.rel = r.relation
        """,
    ),
    "ends": (
        ["coded"],
        """
        select subj as ent_index, part_left as part from coded union all select obj, part_right from coded
        """,
    ),
    "en": (
        ["ents", "ends"],
        """
        select ent as name, ent, c as "count", "index", "partition" from ents
        join (select ent_index, part, count(*)::bigint c from ends group by all)
          on "index" = ent_index and "partition" = part
        """,
    ),
    "rn": (
        ["rels", "coded"],
        """
        select relation as name, relation as ent, c as "count", "index", 0 as "partition" from rels
        join (select rel, count(*)::bigint c from coded group by rel) on "index" = rel
        """,
    ),
    "one": (
        ["l"],
        """
        select subj, min(obj) as obj from l
        where rel = '<http://www.w3.org/2000/01/rdf-schema#label>' and contains(obj, '@en') group by subj
        """,
    ),
    "sn": (["one"], "select subj, coalesce(list_extract(string_split(obj, '\"'), -2), obj) as name from one"),
    "len": (
        ["sn", "ents", "raw"],
        """
        select name, ent, c as "count", "index", "partition" from sn join ents on subj = ent
        join (select subj s, count(*)::bigint c from raw group by subj) on s = ent
        """,
    ),
    "pn": (
        [],
        """
        select p_name as name, concat('/part/', p_partkey) as ent, coalesce(c, 0)::bigint as "count" from part
        left join (select l_partkey, count(*) c from lineitem group by l_partkey) on p_partkey = l_partkey
        """,
    ),
    "rq": (
        [],
        """
        select min(p_partkey) as query_id, upper(p_name) as query, 10 as lim, 0 as off from part group by p_name
        union all
        select min(p_partkey) + (pos + 1) * 1000000000000, word, 20, 95
        from (select p_partkey, unnest(string_split(p_name, ' ')) as word,
                     unnest(range(len(string_split(p_name, ' ')))) as pos from part) group by pos, word
        union all
        select * from (values (-1, '', 7, 3), (-2, 'red red', 10, 0), (-3, 'RED Widget', 10, 0), (-4, 'widge', 10, 2),
                              (-5, 'red', 10, 1000000000), (-6, 'in', 25, 0), (-7, 'red ', 10, 0))
        """,
    ),
    "hits": (
        ["rq", "pn"],
        """
        select query_id, lim, off, ent as value, concat(name, ' ', "count", ' ', ent) as label,
               row_number() over (partition by query_id order by "count" desc, ent)::int as "rank",
               count(*) over (partition by query_id) as size
        from rq join pn on list_has_all(string_split(lower(name), ' '), string_split(lower(query), ' '))
        """,
    ),
    "v": (
        [],
        """
        select vec_id, label, embedding::double[] as x, (vec_id % 4)::int as p, (vec_id // 4)::int as i from embeddings
        """,
    ),
    "first": (["v"], "select label, min(vec_id) as first, arg_min(x, vec_id) as o from v group by label"),
    "proj": (
        ["v", "first"],
        """
        select vec_id, v.label, p, i, side, list_concat(
            list_transform(range(1, 33), lambda j: x[j] * o[j] - x[j + 32] * (s * o[j + 32])),
            list_transform(range(1, 33), lambda j: x[j] * (s * o[j + 32]) + x[j + 32] * o[j])) as y
        from v join first using (label), (values ('lhs', 1), ('rhs', -1)) sides(side, s)
        """,
    ),
    "vn": (
        ["v"],
        """
        select concat('quality ', quality, ' toxic ', toxic) as name, concat('/vec/', vec_id) as uri, vec_id
        from v join labels on vec_id = doc_id
        """,
    ),
    "q": (
        ["proj"],
        """
        select vec_id * 2 + (side = 'rhs')::int as query_id, vec_id, label + 3 as k, y from proj
        """,
    ),
    "scored": (
        ["q", "v"],
        """
        select query_id, q.vec_id as asker, k, v.vec_id, p, i, cast(list_dot_product(y, x) as float) as dist from q, v
        """,
    ),
    "tscored": (
        ["v", "first"],
        """
        select a.vec_id * 2 + (s = -1)::int as query_id, a.vec_id as asker, a.label + 3 as k, b.vec_id, b.p, b.i,
               cast(list_dot_product(list_transform(range(1, 65), lambda j: a.x[j] + s * o[j]), b.x) as float) as dist
        from v a join first on first.label = a.label, (values (1), (-1)) sides(s), v b
        """,
    ),
    "e": (
        ["v", "first"],
        """
        select i as subj, (first // 4)::int as obj, label as rel, p as part_left, (first % 4)::int as part_right, vec_id, first
        from v join first using (label)
        """,
    ),
    "sizes": (
        ["v"],
        """
        select p, c, sum(c) over (order by p) - c as start, sum(c) over () as total
        from (select p, count(*) c from v group by p)
        """,
    ),
    "drawn": (
        ["e"],
        """
        select *, md5(concat_ws(chr(9), 11, 'rhs', subj, obj, rel, part_left, part_right, draw)) as h
        from e, range(1, 501) d(draw)
        """,
    ),
    "neg": (
        ["drawn", "sizes"],
        """
        select subj, obj, rel, part_left, part_right, vec_id, first, draw::int as draw, p as cand_part,
               (n - start)::int as cand_index
        from (select *, ('0x' || substr(h, 1, 15))::bigint % (select any_value(total) from sizes) as n from drawn)
        join sizes on n >= start and n < start + c
        """,
    ),
    "gneg": (
        ["drawn", "v"],
        """
        select drawn.*, p as cand_part, i as cand_index from drawn
        join (select p, i, row_number() over (order by p, i) - 1 as n, count(*) over () as total from v where (i + p) % 3 <> 1) there
        on there.n = ('0x' || substr(h, 1, 15))::bigint % total
        """,
    ),
    "ranks": (
        ["neg", "proj", "v"],
        """
        select neg.subj, neg.obj, rel, part_left, part_right, 1::bigint as copies, any_value(list_dot_product(y, a.x)) as score,
               (1 + count(*) filter (where list_dot_product(y, b.x) > list_dot_product(y, a.x)))::bigint as "rank"
        from neg join proj on proj.vec_id = neg.vec_id and side = 'lhs' join v a on a.vec_id = first
        join v b on b.p = cand_part and b.i = cand_index
        group by neg.subj, neg.obj, rel, part_left, part_right
        """,
    ),
}


def _sql(body: str, *views: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for dependency in VIEWS[name][0]:
                add(dependency)
            needed.append(name)

    for view in views:
        add(view)
    return ("with " + ", ".join(f"{n} as ({VIEWS[n][1].strip()})" for n in needed) + " " if needed else "") + body


def _substring(labels: str, *views: str) -> str:
    return _sql(
        f"""
        select query_id, "rank", value, label, size from (
            select query_id, lim, off, uri as value, label,
                   row_number() over (partition by query_id order by uri)::int as "rank",
                   count(*) over (partition by query_id) as size
            from rq join ({labels}) on contains(lower(label), lower(query)))
        where "rank" > off and "rank" <= off + lim
        """,
        "rq",
        *views,
    )


def _knn(named: str, before: bool = False, pairs: str = "scored") -> str:
    """``named`` joins the scored pairs with the names that hits must have, on ``n.vec_id``."""
    scored = f"(select s.* from {pairs} s {named})" if before else pairs
    return _sql(
        f"""
        select query_id, "rank", uri, round(dist::double, 6) as dist, name from (
            select query_id, k, n.uri, dist, n.name,
                   row_number() over (partition by query_id order by dist desc, p, i)::int as "rank"
            from (select *, row_number() over (partition by query_id, p order by dist desc, i) as place from {scored}) s
            {named} join vn a on a.vec_id = asker where place <= k)
        where "rank" <= k
        """,
        pairs,
        "vn",
    )


_TOKENS = """
    select distinct unnest(string_split(lower(name), ' ')) as word, ent as uri from pn
"""
_SCORE = """
    select e.subj, e.obj, e.rel, e.part_left, e.part_right, round(list_dot_product(y, t.x), 6) as score
    from e join proj on proj.vec_id = e.{source} and side = '{side}' join v t on t.vec_id = e.{target}
"""
_NAMED = "join vn n on n.vec_id = s.vec_id"

ORACLE: dict[str, str] = {
    "parse_triples": _sql("select * from g", "g"),
    "scan_triples": _sql("select * from g", "g"),
    "memory_triples": _sql("select * from g where subj like '/nation/%'", "g"),
    "dict_json_ranges": "select concat('/part, ', p_partkey, '/\"', p_name) as uri, (row_number() over (order by p_partkey) - 1)::int as id from part",
    "last_names": _sql(
        """select name, ent, "count", "index", 0 as "partition" from (
               select *, row_number() over (partition by ent order by "count" desc, "index" desc) as n from (
                   select name, ent, "count", split_part(ent, '/', 3)::int as "index" from pn
                   union all select name, concat('/group/', split_part(ent, '/', 3)::int % 97), "count", split_part(ent, '/', 3)::int from pn))
           where n = 1""",
        "pn",
    ),
    "scan_embeddings": _sql(
        'select p as "partition", i as "index", len(x)::int as dimension, round(list_dot_product(x, x), 6) as norm from v',
        "v",
    ),
    "dict_json_entities": _sql(
        """select ent as uri, (row_number() over (order by substr(md5(ent), 9), ent) - 1)::int as id
           from (select subj as ent from g union select obj from g)""",
        "g",
    ),
    "dict_json_relations": _sql(
        """select rel as uri, (row_number() over (order by substr(md5(rel), 9), rel) - 1)::int as id
           from (select distinct rel from g)""",
        "g",
    ),
    "label_map_json": _sql("select ent as uri, name as label from pn", "pn"),
    "endpoints": _sql("select subj as ent from g union all select obj from g", "g"),
    "entity_min_count": _sql('select * from ec where "count" >= 5', "ec"),
    "relation_min_count": _sql('select * from rc where "count" >= 5', "rc"),
    "relation_membership": _sql('select * from g where rel in (select rel from rc where "count" >= 5)', "rc"),
    "min_count_filter": _sql("select * from f", "f"),
    "english_labels": _sql("select * from l where contains(obj, '@en')", "l"),
    "english_labels_strict": _sql("select * from l where obj like '%\"@en'", "l"),
    "extract_label": _sql(
        "select subj, coalesce(list_extract(string_split(obj, '\"'), -2), obj) as name from l", "l"
    ),
    "distinct_entities": _sql("select subj as ent from g union select obj from g", "g"),
    "distinct_relations": _sql("select distinct rel from g", "g"),
    "split_hash": _sql(
        """select subj, rel, obj, case when b < 8000 then 'train' when b < 9000 then 'valid' else 'test' end as split
           from (select *, ('0x' || substr(md5(concat_ws(chr(9), subj, rel, obj)), 1, 8))::bigint % 10000 b from g)""",
        "g",
    ),
    "split_random": _sql("select subj, rel, obj, count(*) as copies, true as within from g group by all", "g"),
    "import_text": _sql("select * from f", "f"),
    "dataset_roundtrip": _sql(
        """select split, subj, rel, obj from sp where split = 'train' or (subj in (select ent from ents)
               and obj in (select ent from ents) and rel in (select relation from rels))""",
        "sp",
        "ents",
        "rels",
    ),
    "entity_partition_scan": _sql('select * from ents where "partition" = 2', "ents"),
    "stored_names": _sql("select *, 'entity' as kind from en union all select *, 'relation' from rn", "en", "rn"),
    "stored_export": _sql(
        """select subj as lhs, obj as rhs, rel, part_left, part_right, ent as head, 1 as format_version,
               count(*) over (partition by part_left, part_right) as "count"
           from coded join ents on "index" = subj and "partition" = part_left""",
        "coded",
    ),
    "export_without_metadata": _sql(
        'select part_left, part_right, count(*) as "count", false as lists from coded group by all', "coded"
    ),
    "dict_json_repeated": "select concat('/region/', n_regionkey) as uri, max(n_nationkey)::int as id from nation group by all",
    "label_map_repeated": "select p_brand as uri, arg_max(p_name, p_partkey) as label from part group by all",
    "dict_json_files": _sql(
        """select ent as uri, (row_number() over (order by substr(md5(ent), 9), ent) - 1)::int as id
           from (select subj as ent from g union select obj from g)""",
        "g",
    ),
    "relation_word_search": _sql(
        """select a."index"::bigint as query_id, (row_number() over (partition by a."index" order by b."count" desc, b.ent))::int
               as "rank", b.ent as value, concat(b.name, ' ', b."count", ' ', b.ent) as label, 1::bigint as size
           from rn a join rn b on lower(a.name) = lower(b.name)""",
        "rn",
    ),
    "knn_translation": _knn(_NAMED, pairs="tscored"),
    "score_translation": _sql(
        """select e.subj, e.obj, e.rel, e.part_left, e.part_right,
               round(list_dot_product(list_transform(range(1, 65), lambda j: a.x[j] + o[j]), t.x), 6) as score
           from e join v a on a.vec_id = e.vec_id join first on first.label = e.rel join v t on t.vec_id = e.first""",
        "e",
    ),
    "missing_vectors": _sql(
        """select count(*) as edges, count(*) filter (l) as "left", count(*) filter (r) as "right", count(*) filter (l or r) as either
           from (select (part_left + subj) % 3 = 1 as l, (part_right + obj) % 3 = 1 as r from e)""",
        "e",
    ),
    "rank_missing": _sql(
        """select gneg.subj, gneg.obj, rel, part_left, part_right, 1::bigint as copies, round(any_value(list_dot_product(y, a.x)), 6) as score,
               (1 + count(*) filter (where list_dot_product(y, b.x) > list_dot_product(y, a.x)))::bigint as "rank"
           from gneg join proj on proj.vec_id = gneg.vec_id and side = 'lhs' join v a on a.vec_id = first
           join v b on b.p = cand_part and b.i = cand_index
           where (part_left + gneg.subj) % 3 <> 1 and (part_right + gneg.obj) % 3 <> 1
           group by gneg.subj, gneg.obj, rel, part_left, part_right""",
        "gneg",
        "proj",
        "v",
    ),
    "negative_samples_gaps": _sql(
        "select subj, obj, rel, part_left, part_right, draw::int as draw, cand_part, cand_index from gneg", "gneg"
    ),
    "entity_dictionary": _sql("select * from ents", "ents"),
    "relation_dictionary": _sql("select * from rels", "rels"),
    "encode_triples": _sql("select * from coded", "coded"),
    "encode_heldout": _sql(
        """select a."index" as subj, b."index" as obj, r."index" as rel, a."partition" as part_left,
                  b."partition" as part_right
           from h join ents a on h.subj = a.ent join ents b on h.obj = b.ent join rels r on h.rel = r.relation""",
        "h",
        "ents",
        "rels",
    ),
    "dropped_triples": _sql(
        """select * from (
               select *, concat_ws(',', case when subj not in (select ent from ents) then 'subj' end,
                                   case when rel not in (select relation from rels) then 'rel' end,
                                   case when obj not in (select ent from ents) then 'obj' end) as unknown from h)
           where unknown <> ''""",
        "h",
        "ents",
        "rels",
    ),
    "bucket_scan": _sql("select * from coded where part_left = 0 and part_right = 1", "coded"),
    "bucket_export": _sql("select subj as lhs, obj as rhs, rel, part_left, part_right from coded", "coded"),
    "bucket_counts": _sql(
        """select a::int as part_left, b::int as part_right, coalesce(c, 0)::bigint as "count", 1 as format_version
           from range(4) x(a), range(4) y(b)
           left join (select part_left l, part_right r, count(*) c from coded group by all) on l = a and r = b""",
        "coded",
    ),
    "entity_name_list": _sql(
        """select "partition", ("index" // 1000 * 1000)::int as first, to_json(list(ent order by "index"))::varchar as names
           from ents group by all""",
        "ents",
    ),
    "entity_counts": _sql('select "partition", count(ent) as "count" from ents group by all', "ents"),
    "relation_name_list": _sql(
        """select ("index" // 1000 * 1000)::int as first, to_json(list(relation order by "index"))::varchar as names
           from rels group by all""",
        "rels",
    ),
    "relation_count": _sql('select count(relation) as "count" from rels', "rels"),
    "endpoint_union": _sql("select * from ends", "ends"),
    "entity_frequency": _sql('select ent_index, part, count(*) as "count" from ends group by all', "ends"),
    "relation_frequency": _sql('select rel, count(*) as "count" from coded group by all', "coded"),
    "subject_frequency": _sql('select subj, count(*) as "count" from raw group by all', "raw"),
    "raw_relation_frequency": _sql('select rel, count(*) as "count" from raw group by all', "raw"),
    "one_label_per_subject": _sql("select * from one", "one"),
    "entity_names": _sql("select * from en", "en"),
    "relation_names": _sql("select * from rn", "rn"),
    "label_entity_names": _sql("select * from len", "len"),
    "label_relation_names": _sql(
        """select name, relation as ent, c as "count", "index", 0 as "partition" from sn join rels on subj = relation
           join (select rel r, count(*) c from raw group by rel) on r = relation""",
        "sn",
        "rels",
        "raw",
    ),
    "unique_names": _sql(
        """select name, ent, "count", "index", "partition" from (
               select *, row_number() over (partition by ent
                   order by "count" desc, name desc, "index" desc, "partition" desc) as n
               from (select * from en union all select * from len)) where n = 1""",
        "en",
        "len",
    ),
    "top_entities": _sql('select * from en order by "count" desc, ent limit 20', "en"),
    "top_relations": _sql('select * from rn order by "count" desc, ent limit 3', "rn"),
    "word_index": _sql(_TOKENS, "pn"),
    "word_search": _sql('select query_id, "rank", value, label, size from hits', "hits"),
    "search_page": _sql(
        'select query_id, "rank", value, label, size from hits where "rank" > off and "rank" <= off + lim', "hits"
    ),
    "stored_word_search": _sql(
        'select query_id, "rank", value, label, size from hits where "rank" > off and "rank" <= off + lim', "hits"
    ),
    "entity_substring_search": _substring("select ent as uri, name as label from pn", "pn"),
    "relation_substring_search": _substring("select distinct rel as uri, rel as label from g", "g"),
    "project_complex": _sql(
        """select vec_id, unnest(range(64))::int as pos, round(unnest(y), 6) as x from proj where side = 'lhs'""", "proj"
    ),
    "project_translation": _sql(
        """select vec_id, pos::int as pos, round(x[pos + 1] + o[pos + 1], 6) as x
           from v join first using (label), range(64) r(pos)""",
        "first",
    ),
    "inner_product": _sql(
        "select vec_id, round(list_dot_product(x, o), 6) as product from v join first using (label)", "first"
    ),
    "knn_direction": _sql(
        """select vec_id, direction, side, round(list_dot_product(y, x), 6) as product
           from (values ('left', 'lhs'), ('right', 'rhs'), ('LEFT', 'rhs')) d(direction, side)
           join proj using (side) join v using (vec_id)""",
        "proj",
    ),
    "knn_partitioned": _knn(_NAMED),
    "knn_by_norm": _knn(_NAMED),
    "knn_named_before": _knn(_NAMED, before=True),
    "knn_unknown_keys": _sql(
        """select query_id, "rank", uri, round(dist::double, 6) as dist, name from (
               select query_id, n.uri, dist, n.name,
                      row_number() over (partition by query_id order by dist desc, p, i)::int as "rank"
               from (select *, row_number() over (partition by query_id, p order by dist desc, i) as place from (
                         select a.doc_id as query_id, c.vec_id, c.p, c.i, cast(list_dot_product(list_concat(
                             list_transform(range(1, 33), lambda j: b.x[j] * o[j] - b.x[j + 32] * o[j + 32]),
                             list_transform(range(1, 33), lambda j: b.x[j] * o[j + 32] + b.x[j + 32] * o[j])), c.x) as float) as dist
                         from documents a join vn on vn.vec_id = a.doc_id join v b on b.vec_id = a.doc_id
                         join first on first.label = a.doc_id % 12, v c)) s
               join vn n on n.vec_id = s.vec_id where place <= 5)
           where "rank" <= 5""",
        "vn",
        "first",
    ),
    "knn_single_index": _sql(
        """select query_id, "rank", concat('/vec/', s.vec_id) as uri, round(dist::double, 6) as dist,
                  coalesce(name, '') as name
           from (select *, row_number() over (partition by query_id order by dist desc, vec_id)::int as "rank" from scored) s
           left join vn on vn.vec_id = s.vec_id where "rank" <= k""",
        "scored",
        "vn",
    ),
    "knn_single_files": _sql(
        """select query_id, "rank", concat('/vec/', s.vec_id) as uri, round(dist::double, 6) as dist,
                  coalesce(name, '') as name
           from (select *, row_number() over (partition by query_id order by dist desc, vec_id)::int as "rank" from scored) s
           left join vn on vn.vec_id = s.vec_id where "rank" <= k""",
        "scored",
        "vn",
    ),
    "score_triples": _sql(_SCORE.format(source="vec_id", side="lhs", target="first"), "e", "proj"),
    "score_triples_right": _sql(_SCORE.format(source="first", side="rhs", target="vec_id"), "e", "proj"),
    "negative_samples": _sql(
        "select subj, obj, rel, part_left, part_right, draw, cand_part, cand_index from neg", "neg"
    ),
    "rank_edges": _sql(
        'select subj, obj, rel, part_left, part_right, copies, round(score, 6) as score, "rank" from ranks', "ranks"
    ),
    "rank_eval": _sql(
        """select sum(copies)::bigint as edges, round(avg(1.0 / "rank"), 6) as mrr,
                  round(avg(("rank" <= 1)::int), 6) as hits_at_1, round(avg(("rank" <= 10)::int), 6) as hits_at_10
           from ranks""",
        "ranks",
    ),
}
