"""DuckDB SQL for the registered queries, written from the step definitions.

The SQL follows the steps one by one, without the fusions the Spark side makes.
RE2 has neither back-references nor look-around: runs are squeezed on character
lists, and whole words are matched with their neighbours.
"""

from __future__ import annotations

from labeltext.constants import LETTER_AXES, STOP_WORDS, TYPE_CODES
from registry.inputs import CLASS_NAMES, CODE, FLAIR, LEAK_WORDS

W = r"\p{L}\p{N}_"
S = r"\t-\r\x1c-\x20\x{85}\p{Z}"
NL = "chr(10)"
STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

POSTS = f"(select doc_id as row_id, {FLAIR} as author_flair_text, text as body from documents)"
CORPUS = f"(select doc_id, {CODE} as type, text as posts from documents)"
PREDICTIONS = "(select doc_id, quality as label, 1 - toxic as prediction from labels)"


def whole_word(vocab) -> str:
    return f"(^|[^{W}])({'|'.join(vocab)})($|[^{W}])"


def label_of(c: str, vocab=TYPE_CODES) -> str:
    return f"nullif(regexp_extract(upper({c}), '{whole_word(vocab)}', 2), '')"


def words_of(c: str) -> str:
    """Sequence-tokenizer words."""
    return (
        f"list_filter(string_split(regexp_replace(lower({c}), "
        r"'[!-&(-/:-@\[-`{-~\t\n]', ' ', 'g'), ' '), lambda w: w <> '')"
    )


def tokens_of(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '[{W}]{{2,}}')"


def forum_clean(source: str, key: str, text: str) -> str:
    """CTEs ending in ``cleaned(key, words)`` for the two forum variants."""
    return f"""
    lowered as (select {key}, replace(lower({text}), '_', ' ') as t from {source}),
    chars as (select {key}, string_split(t, '') as ch from lowered),
    squeezed as (select {key}, array_to_string(list_filter(ch, lambda x, i: not coalesce(
        i > 1 and ch[i] = ch[i-1] and ch[i] <> {NL}
        and ((i > 2 and ch[i-1] = ch[i-2]) or ch[i] = ch[i+1]), false)), '') as t from chars),
    worded as (select {key}, regexp_replace(t, '[^{W}{S}]', '', 'g') as t from squeezed),
    undigit as (select {key}, regexp_replace(t, '\\p{{Nd}}+', '', 'g') as t from worded),
    ascii as (select {key}, regexp_replace(t, '[^\\x00-\\x7F]+', ' ', 'g') as t from undigit),
    spaced as (select {key}, trim(regexp_replace(t, '[\\t-\\r\\x1c-\\x20]+', ' ', 'g')) as t from ascii),
    cleaned as (select {key}, list_filter(string_split(t, ' '),
        lambda w: w <> '' and w not in ({STOP})) as words from spaced)"""


def decoded(c: str) -> str:
    """The entities that occur in the pages; ``&amp;`` last keeps it one pass."""
    for entity, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        c = f"replace({c}, '{entity}', '{char}')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


def model_clean(c: str) -> str:
    c = f"regexp_replace(lower({c}), 'http[^{S}]+|www[^{S}]+', '', 'g')"
    c = f"regexp_replace({c}, '<[^\\n]*?>', '', 'g')"
    c = f"regexp_replace({c}, '[^a-z{S}]', '', 'g')"
    return f"trim(regexp_replace({c}, '[{S}]+', ' ', 'g'))"


def basic_text(c: str) -> str:
    return f"replace(replace({decoded(c)}, {NL}, ' '), '\\n', ' ')"


LEAK = f"regexp_matches(upper(body), '{whole_word(LEAK_WORDS)}')"
BLANK = f"not regexp_matches(body, '[^{S}]')"

ETL = f"""with labelled as (select row_id, {label_of('author_flair_text')} as type, body from {POSTS}),
    kept as (select * from labelled where type is not null and not {LEAK} and not ({BLANK})),
    firsts as (select row_id, type, body from kept
        qualify row_number() over (partition by body order by row_id) = 1),
    {forum_clean('firsts', 'row_id', 'body')},
    ranged as (select row_id, type, array_to_string(words, ' ') as posts
        from cleaned join firsts using (row_id) where len(words) between 10 and 1000)"""

TOKENS = f"tokens as (select doc_id, type, unnest({tokens_of('posts')}) as term from {CORPUS})"
CONTENT = f"content as (select * from tokens where term not in ({STOP}))"

SEQ_WORDS = f"""words as (select doc_id, unnest(w) as word, unnest(range(len(w))) as pos
        from (select doc_id, {words_of('posts')} as w from {CORPUS}))"""


def seq_vocab(num_words: int) -> str:
    return f"""counted as (select word, count(*) as n, min(doc_id * 2147483648::hugeint + pos) as first
        from words group by word),
    vocab as (select word, (row_number() over (order by n desc, first) + 1)::int as idx
        from counted order by n desc, first limit {num_words - 2})"""


CLASS_SCORES = f"""sides as (
        select label as class, 1 as t, 0 as p, (label = prediction)::int as hit from {PREDICTIONS}
        union all select prediction, 0, 1, 0 from {PREDICTIONS}),
    counts as (select class, sum(t)::double as t, sum(p)::double as p, sum(hit)::double as hit
        from sides group by class),
    scores as (select class, case when p = 0 then 0 else hit / p end as precision,
        case when t = 0 then 0 else hit / t end as recall,
        case when t + p = 0 then 0 else 2 * hit / (t + p) end as f1,
        t::bigint as support, hit from counts)"""

SOFTMAX = """exps as (select vec_id, label, list_transform(embedding,
        lambda x: exp(x::double * {scale} - list_max(embedding)::double * {scale})) as e from embeddings),
    probs as (select vec_id, label, list_transform(e, lambda x: x / list_sum(e)) as p from exps)"""

NAMES = "[" + ", ".join(f"'{c}'" for c in CLASS_NAMES) + "]"


def described(c: str, default: str) -> str:
    known = ", ".join(f"'{x}'" for x in CLASS_NAMES[:32])
    return f"case when {c} in ({known}) then 'class ' || {c} else '{default}' end"


def cell(nxy: str, nx: str, ny: str) -> str:
    return f"case when {nxy} > 0 then {nxy} / n * ln({nxy} * n / ({nx} * {ny})) else 0 end"


ORACLE: dict[str, str] = {
    "csv_roundtrip": "select doc_id as row_id, source as author_flair_text, text as body from documents",
    "csv_split_roundtrip": """select doc_id as row_id, source as author_flair_text,
        '"' || replace(text, ' ', chr(10)) || '",' || chr(10) as body from documents""",
    "extract_label": f"select row_id, author_flair_text, {label_of('author_flair_text')} as type from {POSTS}",
    "extract_label_orders": (
        "select o_orderkey, "
        + label_of("o_orderpriority", ("URGENT", "HIGH", "MEDIUM", "LOW"))
        + " as priority from orders"
    ),
    "drop_unlabelled": (
        f"select row_id, {label_of('author_flair_text')} as type from {POSTS} "
        f"where {label_of('author_flair_text')} is not null"
    ),
    "drop_mentions": f"select row_id, body from {POSTS} where not {LEAK}",
    "drop_blank": (
        r"select doc_id, rest from (select doc_id, regexp_replace(text, '[\p{L}\p{N}.,|]', '', 'g') as rest "
        f"from documents) where regexp_matches(rest, '[^{S}]')"
    ),
    "word_count": (
        f"select doc_id, len(regexp_extract_all(text, '[^{S}]+'))::int as words from documents"
    ),
    "filter_word_range": (
        "select doc_id, n_chars from documents "
        f"where len(regexp_extract_all(text, '[^{S}]+')) between 10 and 1000"
    ),
    "axis_label": (
        "select doc_id, upper(lang) as code, case substr(upper(lang), 1, 1) "
        "when 'D' then 1 when 'E' then 0 end as y from documents"
    ),
    "select_corpus": f"select type, posts from {CORPUS}",
    "prepare_corpus": (
        ETL + " select type, posts from ranged "
        "qualify row_number() over (partition by posts order by row_id) = 1 order by posts"
    ),
    "prepare_corpus_pages": f"""with raw as (select page_id as row_id, html as body from pages),
    kept as (select * from raw where not {LEAK} and not ({BLANK})),
    firsts as (select * from kept qualify row_number() over (partition by body order by row_id) = 1),
    {forum_clean('firsts', 'row_id', basic_text('body'))}
    select 'ISTP' as type, array_to_string(words, ' ') as posts from cleaned
    where len(words) between 10 and 1000
    qualify row_number() over (partition by array_to_string(words, ' ') order by row_id) = 1
    order by posts""",
    "funnel": ETL + f""", n as (select
        (select count(*) from documents) as r0,
        (select count(*) from labelled where type is not null) as r1,
        (select count(*) from labelled where type is not null and not {LEAK}) as r2,
        (select count(*) from kept) as r3, (select count(*) from firsts) as r4,
        (select count(*) from ranged) as r5, (select count(distinct posts) from ranged) as r6)
    """ + " union all ".join(
        f"select {i + 1} as step_no, '{name}' as step, r{i} as rows_before, "
        f"r{i + 1} as rows_after, r{i} - r{i + 1} as removed from n"
        for i, name in enumerate(
            ("label", "mentions", "blank", "raw duplicates", "word range", "clean duplicates")
        )
    ),
    "dedup_raw": (
        f"select row_id, author_flair_text, body from {POSTS} "
        "qualify row_number() over (partition by body order by row_id) = 1"
    ),
    "dedup_clean": (
        f"with c as (select doc_id, type, {model_clean('posts')} as posts from {CORPUS}) "
        "select * from c qualify row_number() over (partition by posts order by doc_id) = 1 order by posts"
    ),
    "build_vocab": (
        f"with {TOKENS} select term, count(*) as n from tokens group by term "
        "order by n desc, term limit 1000"
    ),
    "clean_basic": (
        f"with {forum_clean('pages', 'page_id', basic_text('html'))} "
        "select page_id, array_to_string(words, ' ') as cleaned from cleaned"
    ),
    "clean_parallel": (
        f"with {forum_clean('documents', 'doc_id', 'text')} "
        "select doc_id, array_to_string(words, ' ') as cleaned from cleaned"
    ),
    "clean_model": f"select doc_id, {model_clean('text')} as cleaned from documents",
    "clean_model_pages": (
        f"""select page_id, {model_clean("url || ' ' || html")} as cleaned from pages"""
    ),
    "remove_stop_words": (
        "select conv_id, turn, array_to_string(list_filter(string_split(lower(text), ' '), "
        f"lambda w: w not in ({STOP})), ' ') as kept from conversations"
    ),
    "unescape_html": f"select page_id, {decoded('html')} as decoded from pages",
    "tokenize_words": (
        f"select conv_id, turn, array_to_string({tokens_of('text')}, ' ') as tokens from conversations"
    ),
    "tokenize_keras": (
        f"""with t as (select page_id, {words_of("url || '''' || html")} as w from pages) """
        "select page_id, len(w)::int as n, array_to_string(w, ' ') as tokens from t"
    ),
    "token_counts": f"with {TOKENS} select type, term, count(*) as n from tokens group by type, term",
    "class_distribution": f"""select type, count(*) as n,
        round(100.0 * count(*)::double / (select count(*) from documents), 6) as pct
        from {CORPUS} group by type""",
    "class_distribution_events": """select event_type, count(*) as n,
        round(100.0 * count(*)::double / (select count(*) from events), 6) as pct
        from events group by event_type""",
    "axis_marginals": " union all ".join(
        f"select '{axis}' as axis, '{letter}' as letter, n, round(100.0 * n / total, 6) as pct from "
        f"(select count(*) filter (substr(type, {pos}, 1) = '{letter}') as n, "
        f"count(*)::double as total from {CORPUS})"
        for axis, pos, letters in LETTER_AXES
        for letter in letters
    ),
    "distinct_labels": f"select distinct type from {CORPUS}",
    "top_words": f"""with {TOKENS}, {CONTENT}
        select type, term, n, rank::int as rank from (select type, term, count(*) as n,
            row_number() over (partition by type order by count(*) desc, term) as rank
            from content group by type, term) where rank <= 20""",
    "class_tfidf": f"""with {TOKENS}, {CONTENT},
        counts as (select type, term, count(*) as n from content group by type, term),
        vocab as (select term, count(*) as df from counts group by term
            order by sum(n) desc, term limit 10000),
        weights as (select type, term, n * (ln((1.0 + (select count(distinct type) from {CORPUS}))
            / (1.0 + df)) + 1) as w from counts join vocab using (term)),
        scored as (select type, term,
            round(w / sqrt(sum(w * w) over (partition by type)), 9) as score from weights)
        select type, term, score, rank::int as rank from (select *,
            row_number() over (partition by type order by score desc, term) as rank from scored)
        where rank <= 10""",
    "mutual_information": f"""with {TOKENS}, {CONTENT},
        vocab as (select term from content group by term order by count(*) desc, term limit 10000),
        y as (select doc_id, case substr(type, 1, 1) when 'I' then 1 else 0 end as y from {CORPUS}),
        per_doc as (select doc_id, term, count(*) as c from content semi join vocab using (term)
            group by doc_id, term),
        totals as (select sum(y)::double as t1, sum(1 - y)::double as t0, count(*)::double as n from y),
        present as (select term, c, sum(y)::double as n1, sum(1 - y)::double as n0
            from per_doc join y using (doc_id) group by term, c),
        absent as (select term, 0 as c, any_value(t1) - sum(n1) as n1, any_value(t0) - sum(n0) as n0
            from present, totals group by term),
        cells as (select * from (select * from present union all select * from absent), totals)
        select term, round(greatest(sum({cell('n1', '(n1 + n0)', 't1')} + {cell('n0', '(n1 + n0)', 't0')}), 0), 9)
            as mi from cells group by term order by mi desc, term limit 10""",
    "concat_by_group": (
        "select conv_id, string_agg(text, ' ' order by turn) as text from conversations group by conv_id"
    ),
    "class_weights": f"""select type, count(*) as n, round((select count(*) from documents)::double
        / ((select count(distinct type) from {CORPUS}) * count(*)), 9) as weight
        from {CORPUS} group by type""",
    "tfidf_table": f"""with {TOKENS},
        counts as (select doc_id, term, count(*) as n from tokens group by doc_id, term),
        freq as (select term, count(*) as df from counts group by term),
        weights as (select doc_id, term, n * (ln((1.0 + (select count(*) from documents))
            / (1.0 + df)) + 1) as w from counts join freq using (term))
        select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight
        from weights""",
    "tfidf_vectors": f"""with {TOKENS},
        counts as (select doc_id, term, count(*) as n from tokens group by doc_id, term),
        freq as (select term, count(*) as df, row_number() over (order by term) - 1 as idx from counts group by term),
        weights as (select doc_id, idx, n * (ln((1.0 + (select count(*) from documents))
            / (1.0 + df)) + 1) as w from counts join freq using (term))
        select doc_id, idx, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight
        from weights""",
    "count_vectors": f"""with {TOKENS},
        top as (select term from tokens group by term order by count(*) desc, term limit 1000),
        vocab as (select term, (row_number() over (order by term) - 1)::int as idx from top)
        select doc_id, idx, count(*) as n from tokens join vocab using (term) group by doc_id, idx""",
    "encode_labels": f"""select doc_id, type,
        (dense_rank() over (order by type) - 1)::int as label from {CORPUS}""",
    **{name: f"""select lang as class, count(*) as support, true as beats_majority, true as accurate{more} from documents
        where substr(md5('42:' || doc_id), 1, 8) < '33333333' group by lang"""
       for name, more in (("lr_eval", ", true as gradient_small"), ("rf_eval", ""), ("rf_svd_eval", ""), ("mlp_eval", ""),
                          ("sequence_eval", ", true as loss_falls, true as best_kept"))},
    **{name: """select conv_id, turn, 2::bigint as version, true as same from conversations
        where trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> ''"""
       for name in ("model_roundtrip", "score_stream")},
    "svd_features": """select vec_id, round(list_sum(list_transform(embedding, lambda x: x::double * x::double)), 5)
        as squared_length from embeddings where len(list_filter(embedding, lambda x: x <> 0)) > 0""",
    "score_texts": """select conv_id, turn, true as ok, case when length(text) < 500 then null
            when regexp_matches(text, '[äßü]') then 'de' when regexp_matches(text, '[ñíó]') then 'es'
            when regexp_matches(text, '[èçêà]') then 'fr' end as language from conversations
        where trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> ''""",
    "drop_empty_input": """select conv_id, turn,
        trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as text
        from conversations
        where trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> ''""",
    "decode_labels": "select vec_id, 'c' || label as name from embeddings",
    "corpus_to_weights": ETL + """ , train as (select type from (select * from ranged
            qualify row_number() over (partition by posts order by row_id) = 1)
            where substr(md5('42:' || row_id), 1, 8) >= '33333333'),
        counts as (select type, count(*) as n from train group by type)
        select type, n, round((select sum(n) from counts)::double
            / ((select count(*) from counts) * n), 9) as weight from counts""",
    "split_train_val": (
        "select doc_id, substr(md5('42:' || doc_id), 1, 8) < '33333333' as is_val from documents"
    ),
    "sequence_vocab": f"with {SEQ_WORDS}, {seq_vocab(1000)} select word, idx from vocab",
    "encode_sequences": f"""with {SEQ_WORDS}, {seq_vocab(1000)},
        coded as (select doc_id, string_agg(coalesce(idx, 1)::varchar, ' ' order by pos) as seq
            from words left join vocab using (word) group by doc_id)
        select doc_id, coalesce(seq, '') as seq from documents left join coded using (doc_id)""",
    "pad_sequences": f"""with {SEQ_WORDS}, {seq_vocab(10000)},
        coded as (select doc_id, list(coalesce(idx, 1) order by pos) as a
            from words left join vocab using (word) group by doc_id),
        cut as (select doc_id, coalesce(a[greatest(len(a) - 499, 1):], []) as a
            from documents left join coded using (doc_id))
        select doc_id, array_to_string(list_concat(a, list_transform(range(500 - len(a)), lambda i: 0)), ' ')
            as seq from cut""",
    "encoding_summary": f"""with {SEQ_WORDS},
        s as (select substr(md5('42:' || doc_id), 1, 8) < '33333333' as v from documents)
        select count(*) filter (not v) as train_rows, count(*) filter (v) as val_rows,
            (select count(distinct word) + 1 from words) as vocab_size, 500 as max_length from s""",
    "accuracy": f"select round(avg((label = prediction)::int), 9) as accuracy from {PREDICTIONS}",
    "classification_report": f"""with {CLASS_SCORES},
        t as (select sum(hit) / sum(support) as accuracy, sum(support)::bigint as n,
            avg(precision) as mp, avg(recall) as mr, avg(f1) as mf,
            sum(precision * support) / sum(support) as wp, sum(recall * support) / sum(support) as wr,
            sum(f1 * support) / sum(support) as wf from scores),
        r as (select class::varchar as class, precision, recall, f1, support from scores
            union all select 'accuracy', null, null, accuracy, n from t
            union all select 'macro avg', mp, mr, mf, n from t
            union all select 'weighted avg', wp, wr, wf, n from t)
        select class, round(precision, 9) as precision, round(recall, 9) as recall,
            round(f1, 9) as f1, support from r""",
    "f1_scores": f"""with {CLASS_SCORES} select round(avg(f1), 9) as macro_f1,
        round(sum(f1 * support) / sum(support), 9) as weighted_f1 from scores""",
    "confusion_matrix": f"""with seen as (select label as c from {PREDICTIONS}
            union select prediction from {PREDICTIONS})
        select a.c as label, b.c as prediction, (select count(*) from {PREDICTIONS} p
            where p.label = a.c and p.prediction = b.c) as n from seen a, seen b""",
    "log_loss": f"""with {SOFTMAX.format(scale='1.0::double')}
        select round(avg(-ln(p[label + 1] + 1e-10)), 9) as log_loss from probs""",
    "softmax": f"""with {SOFTMAX.format(scale='1.0::double')}
        select vec_id, unnest(range(len(p)))::int as idx, round(unnest(p), 9) as p from probs""",
    "score_probabilities": f"""with {SOFTMAX.format(scale='20.0::double')},
        best as (select vec_id, {NAMES}[list_position(p, list_max(p))] as predicted_type,
            list_max(p) * 100 as confidence from probs)
        select vec_id, predicted_type, round(confidence, 6) as confidence,
            {described('predicted_type', 'No description available')} as description from best""",
    "alternatives": f"""with {SOFTMAX.format(scale='20.0::double')},
        cells as (select vec_id, unnest(p) as p, unnest(range(len(p))) as idx, list_max(p) as top from probs),
        ranked as (select *, row_number() over (partition by vec_id order by p desc, idx) as rank from cells),
        other as (select vec_id, rank::int as rank, {NAMES}[idx + 1] as alternative, p * 100 as confidence
            from ranked where rank between 2 and 3 and top * 100 < 70)
        select vec_id, rank, alternative, round(confidence, 6) as confidence,
            {described('alternative', '')} as description from other""",
}

ORACLE["encoders_roundtrip"] = ORACLE["sequence_vocab"]
ORACLE["report_roundtrip"] = ORACLE["classification_report"]
ORACLE["accounted_corpus"] = f"select *, true as timed from ({ORACLE['funnel']})"
ORACLE["corpus_split_rows"] = f"""select type, count(*) as n, count(*) as numbers, sum(length(posts))::bigint as chars,
    min(md5(posts)) as least from ({ORACLE['prepare_corpus']}) group by type"""
