"""SQL (DuckDB) of the operators it can state over whole tables."""

SLICED_TOPK = r"""
    with whole as (
        select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
        where vec_id is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    ranked as (
        select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score,
            row_number() over (partition by a.vec_id order by score desc, b.vec_id) as rank
        from whole a join whole b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
        where a.vec_id % 100 = 0)
    select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""

HARD_NEGATIVES = r"""
    with rows as (
        select vec_id, embedding, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
        from embeddings
        where vec_id is not null and label is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    whole as (
        select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from rows),
    scores as (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
            cast(list_inner_product(a.v, b.v) as bigint) as score
        from whole a join whole b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
        where a.vec_id % 100 = 0),
    positives as (
        select anchor_id, other_id as positive_id, score as positive_score from scores where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
    select p.anchor_id, p.positive_id,
        cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id)
            as integer) as rank,
        s.other_id as negative_id, p.positive_score, s.score as negative_score
    from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
        and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
    qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) <= 10
"""

RANKED_SEARCH = r"""
    with words as (
        select rowid_ as doc_row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from (select row_number() over () as rowid_, doc_id, text from documents)),
    item_terms as (
        select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark where item_id is not null),
    lengths as (select doc_row, doc_id, count(*) as n from words group by all),
    totals as (select count(*) as docs, cast(sum(n) as bigint) as all_terms from lengths),
    counted as (
        select doc_row, doc_id, term, count(*) as tf from words
        where term in (select term from item_terms) group by all),
    weights as (
        select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
        from counted, totals group by term, docs),
    norms as (
        select doc_row, 100 - 90 + ((90 * n * docs) // all_terms) as m from lengths, totals),
    scores as (
        select item_id, doc_row, doc_id,
            cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
        from item_terms join counted using (term) join weights using (term) join norms using (doc_row)
        where doc_id is not null group by all)
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
        doc_id, score
    from scores where score > 0
    qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
"""
