"""Independent SQL (DuckDB) for every query that SQL can express."""

from __future__ import annotations

_REVIEWS = """
reviews as (
  select d.doc_id reviewID, d.source asin,
         cast(d.n_chars%11 as int) helpfulPos, cast(d.doc_id%4 as int) helpfulNeg,
         cast(d.n_chars%5+1 as double) overall, d.text reviewText,
         concat('u', d.doc_id%37) reviewerID,
         cast(1356998400 + (d.doc_id*7919)%500*86400 + d.n_chars%86400 as bigint) unixReviewTime,
         cast(l.quality as double) label
  from documents d join labels l on d.doc_id = l.doc_id
)"""

_RATED = """
rated as (
  select l_partkey, l_suppkey, cast((l_linenumber-1)%5+1 as double) rating from lineitem
)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _profile(source: str, key: str, rating: str, name: str, prefix: str) -> str:
    """One count table per rating, joined by key: the form with six inputs."""
    counts = [
        f"n{k} as (select {key} k, count(*) c from {source}"
        f" where {rating} = {k} and {key} is not null group by 1)"
        for k in range(1, 6)
    ]
    total = f"tot as (select {key} k, count(*) c from {source} where {key} is not null group by 1)"
    joins = " ".join(f"left join n{k} on n{k}.k = tot.k" for k in range(1, 6))
    stars = ", ".join(
        f"pow(coalesce(n{k}.c,0),2)/tot.c*{20*k} as {prefix}{k}star" for k in range(1, 6)
    )
    select = f"select tot.k as {name}, {stars} from tot {joins}"
    return ", ".join([*counts, total]), select


def _profile_query(view: str, source: str, key: str, rating: str, name: str, prefix: str) -> str:
    counts, select = _profile(source, key, rating, name, prefix)
    return f"with {view}, {counts} {select}"


_PROFILES = """
joined as (
  select r.*,
    {stars}
  from reviews r
  where asin is not null and reviewerID is not null
)""".format(
    stars=", ".join(
        f"pow(count(*) filter (where overall = {k}) over (partition by {key}),2)"
        f" / count(*) over (partition by {key}) * {20*k} as {p}{k}star"
        for p, key in (("p", "asin"), ("u", "reviewerID"))
        for k in range(1, 6)
    )
)

_LINE_STARS = ", ".join(
    f"pow(count(*) filter (where rating = {k}) over (partition by {key}), 2)"
    f" / count(*) over (partition by {key}) * {20*k} as {p}{k}star"
    for p, key in (("p", "l_partkey"), ("u", "l_suppkey"))
    for k in range(1, 6)
)

_RATE = """
rates as (
  select reviewerID,
    count(*) / cast(max(unixReviewTime)//86400 - min(unixReviewTime)//86400 + 1 as double) as reviewRate
  from reviews where asin is not null and reviewerID is not null group by 1
)"""


def _word_count(text: str) -> str:
    return (
        f"cast(case when {text} = '' then 1 when rtrim({text}, ' ') = '' then 0"
        f" else len(string_split(rtrim({text}, ' '), ' ')) end as int)"
    )


def _capital_ratio(text: str) -> str:
    n = f"length(replace({text}, ' ', ''))"
    u = f"len(list_filter(string_split(replace({text}, ' ', ''), ''), lambda c: c = upper(c)))"
    # Integer form of rounding half up to two places.
    return f"case when {n} = 0 then 1.0 else ((200*{u} + {n}) // (2*{n})) / 100.0 end"


_WHITESPACE = r"[ \t\n\x0B\f\r]"


def _surface(text: str) -> str:
    return (
        f"string_split_regex(regexp_replace({text}, '[,.!?:;]', '', 'g'), '{_WHITESPACE}+')"
    )


def _kept(tokens: str) -> str:
    return (
        f"list_transform(list_filter({tokens}, lambda t: length(t) > 2 and t <> 'stopWord'),"
        " lambda t: lower(t))"
    )


def _normalized(text: str) -> str:
    return f"coalesce(array_to_string({_kept(_surface(text))}, ' '), '')"


_FEATURES = f"""
features as (
  select cast(j.reviewID as double) reviewID, cast(helpfulPos - helpfulNeg as double) helpfulness,
    overall rating, {_capital_ratio('reviewText')} capitalLetterRatio,
    cast({_word_count('reviewText')} as double) reviewWordCount,
    p1star pstar1, p2star pstar2, p3star pstar3, p4star pstar4, p5star pstar5,
    u1star ustar1, u2star ustar2, u3star ustar3, u4star ustar4, u5star ustar5,
    r.reviewRate userReviewRate, label
  from joined j join rates r using (reviewerID)
)"""

_FEATURE_TEXT = """
feature_text as (
  select reviewID, label,
    concat(helpfulness, ' ', rating, ' ', capitalLetterRatio, ' ', reviewWordCount, ' ',
      pstar1, ' ', pstar2, ' ', pstar3, ' ', pstar4, ' ', pstar5, ' ',
      ustar1, ' ', ustar2, ' ', ustar3, ' ', ustar4, ' ', ustar5, ' ', pstar1) featureText
  from features
)"""

_REVIEW_FEATURES = [_REVIEWS, _PROFILES, _RATE, _FEATURES]

_TEXTS = f"""
texts as (select reviewID, label, {_normalized('reviewText')} txt from reviews)"""

_COUNTS = """
words as (select reviewID id, unnest(string_split(txt, ' ')) term from texts),
counts as (select id, term, cast(count(*) as int) tf from words group by 1, 2),
freq as (select term, count(distinct id) df from counts group by 1)"""

_WEIGHTS = """
weights as (
  select c.id, c.term, c.tf, f.df,
    c.tf * ln(((select count(*) from texts) + 1) / cast(f.df + 1 as double)) weight
  from counts c join freq f using (term)
)"""

_IN_TRAIN = "substr(md5(cast({key} as varchar)), 1, 8) < '9999999a'"

_BAYES = f"""
train as (select w.*, t.label from weights w join texts t on w.id = t.reviewID
  where {_IN_TRAIN.format(key='w.id')}),
vocabulary as (select distinct term from counts),
classes as (select unnest([0.0::double, 1.0::double]) label),
sums as (
  select c.label, v.term, coalesce(sum(t.weight), 0) weight_sum
  from classes c cross join vocabulary v
  left join train t on t.label = c.label and t.term = v.term group by 1, 2
),
theta as (
  select label, term, weight_sum,
    ln(weight_sum + 1) - ln(sum(weight_sum) over (partition by label)
      + count(*) over (partition by label)) theta
  from sums
),
priors as (
  select label, count(*) n,
    ln(count(*) + 1.0) - ln((select count(*) from texts where {_IN_TRAIN.format(key='reviewID')}) + 2.0) pi
  from texts where {_IN_TRAIN.format(key='reviewID')} group by 1
)"""


_SCORES = f"""
scores as (
  select w.id, t.label, sum(w.weight * t.theta) + any_value(p.pi) score
  from weights w join theta t using (term) join priors p on p.label = t.label
  where not {_IN_TRAIN.format(key='w.id')} group by 1, 2
)"""


def _bayes_at(smoothing: str, sums: str, by: str) -> str:
    """theta at a smoothing, from ``sums`` (by, label, term, weight_sum); ln(0) is -inf."""
    return f"""
  select {by}, label, term,
    case when weight_sum + {smoothing} = 0 then '-infinity'::double else ln(weight_sum + {smoothing}) end
    - ln(sum(weight_sum) over (partition by {by}, label)
      + {smoothing} * count(*) over (partition by {by}, label)) theta
  from {sums}"""


_PREDICTED = """
  case when isnan(score0) or isnan(score1) then 0.0::double
       when score1 > score0 then 1.0::double else 0.0::double end"""

_UNSMOOTHED = f"""
bare as (select *, 0 as one from sums),
bare_theta as ({_bayes_at('0.0', 'bare', 'one')}),
bare_scores as (
  select w.id,
    sum(w.weight * t.theta) filter (where t.label = 0)
      + ln(any_value(n.n0) / any_value(n.n0 + n.n1)) score0,
    sum(w.weight * t.theta) filter (where t.label = 1)
      + ln(any_value(n.n1) / any_value(n.n0 + n.n1)) score1
  from weights w join bare_theta t using (term)
  cross join (select max(n) filter (where label = 0)::double n0,
                max(n) filter (where label = 1)::double n1 from priors) n
  where not {_IN_TRAIN.format(key='w.id')} group by 1
)"""

_FOLD_OF = "cast(('0x' || substr(md5('fold:' || cast({key} as varchar)), 1, 8))::bigint % 7 as int)"

# Every fold and smoothing trained anew, on the rows of the other folds.
_CV = f"""
fold_rows as (select *, {_FOLD_OF.format(key='id')} fold from train),
grid as (select f, s from (select unnest(range(7)) f) cross join (select unnest([0.0::double, 0.5, 1.0]) s)),
fold_sums as (
  select g.f, g.s, c.label, v.term, coalesce(sums.weight_sum, 0) weight_sum
  from grid g cross join classes c cross join vocabulary v
  left join (
    select o.f, r.label, r.term, sum(r.weight) weight_sum
    from (select unnest(range(7)) f) o join fold_rows r on r.fold <> o.f group by 1, 2, 3
  ) sums on sums.f = g.f and sums.label = c.label and sums.term = v.term
),
fold_theta as ({_bayes_at('s', 'fold_sums', 'f, s')}),
fold_docs as (select distinct id, label, fold from fold_rows),
fold_priors as (
  select g.f, g.s, c.label,
    ln(count(d.id) filter (where d.label = c.label) + g.s) - ln(count(d.id) + 2 * g.s) pi
  from grid g cross join classes c join fold_docs d on d.fold <> g.f group by 1, 2, 3
),
fold_scores as (
  select r.id, r.fold, r.label, t.s,
    sum(r.weight * t.theta) filter (where t.label = 0) + any_value(p0.pi) score0,
    sum(r.weight * t.theta) filter (where t.label = 1) + any_value(p1.pi) score1
  from fold_rows r join fold_theta t on t.f = r.fold and t.term = r.term
  join fold_priors p0 on p0.f = t.f and p0.s = t.s and p0.label = 0
  join fold_priors p1 on p1.f = t.f and p1.s = t.s and p1.label = 1
  group by 1, 2, 3, 4
),
fold_guesses as (
  select id, fold, label, s as smoothing, {_PREDICTED} as prediction from fold_scores
),
fold_accuracy as (
  select smoothing, fold, avg(case when label = prediction then 1.0::double else 0 end) accuracy
  from fold_guesses group by 1, 2
),
grid_accuracy as (select smoothing, avg(accuracy) accuracy from fold_accuracy group by 1),
best as (select arg_min(smoothing, (-accuracy, smoothing)) s from grid_accuracy)"""


def _metrics(source: str, label: str, prediction: str) -> str:
    return f"""
cells as (select cast({label} as double) label, cast({prediction} as double) prediction from {source}),
per_class as (
  select c.label k, count(*) support,
    count(*) filter (where c.prediction = c.label) hits,
    (select count(*) from cells p where p.prediction = c.label) predicted
  from cells c group by 1
),
rates as (
  select support, hits, case when predicted = 0 then 0 else hits/predicted::double end p,
    hits/support::double r from per_class
),
summary as (
  select sum(hits)::double/sum(support) accuracy,
    sum(p*support)/sum(support) weightedPrecision, sum(r*support)/sum(support) weightedRecall,
    sum(case when p+r = 0 then 0 else 2*p*r/(p+r) end * support)/sum(support) f1 from rates
)"""


_METRIC_ROWS = " union all ".join(
    f"select '{m}' as metric, round({m}, 9) as value from summary"
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")
)


def _lines(quality: int, prefix: str) -> str:
    """Every line of the chosen texts, numbered by document and line."""
    return f"""
    select '{prefix}' || (row_number() over (order by doc_id, pos) - 1) as id, value,
           {quality} as label
    from (select d.doc_id, unnest(string_split(d.text, chr(10))) as value,
                 unnest(range(len(string_split(d.text, chr(10))))) as pos
          from documents d join labels l on d.doc_id = l.doc_id where l.quality = {quality})"""


def _lemma_query(rows: str, columns: str) -> str:
    """Texts of ``rows`` (doc_id, columns, text), with the lemmas of the documents."""
    return f"""
with rows as ({rows}),
own as (select doc_id, {_surface('text')} ts from documents),
lemmas as (
  select distinct surface, left(surface, length(surface) - 1) lemma
  from (select unnest(ts) surface from own)
  where surface like '%s' and length(surface) > 4
),
split as (select doc_id, {_surface('text')} ts from rows),
tok as (select doc_id, unnest(ts) surface, unnest(range(len(ts))) pos from split),
merged as (
  select doc_id, pos, coalesce(lemma, surface) t from tok left join lemmas using (surface)
),
done as (
  select doc_id, string_agg(lower(t), ' ' order by pos) normalized from merged
  where length(t) > 2 and t <> 'stopWord' group by 1
)
select {columns}, coalesce(normalized, '') as normalized from rows left join done using (doc_id)"""


def _rate_query(source: str, user: str, stamp: str) -> str:
    day = f"cast(floor(epoch({stamp}) / 86400) as bigint)"
    return (
        f"select {user}, count(*) / cast(max({day}) - min({day}) + 1 as double) as reviewRate"
        f" from {source} where {user} is not null group by 1"
    )


_FOLD = "cast(('0x' || substr(md5('fold:' || cast(doc_id as varchar)), 1, 8))::bigint % 7 as int)"

ORACLES: dict[str, str] = {
    "read_labeled_reviews": f"""
        {_with(_REVIEWS)} select reviewID, asin, helpfulPos, helpfulNeg,
          overall, reviewText, cast(null as varchar) as reviewTime, reviewerID,
          cast(null as varchar) as reviewerName, cast(null as varchar) as summary,
          unixReviewTime, label from reviews""",
    "null_report": f"""
        {_with(_REVIEWS)}
        select 'reviewID' as "column", count(*) filter (where reviewID is null) as nulls from reviews
        union all select 'asin', count(*) filter (where asin is null) from reviews
        union all select 'reviewerID', count(*) filter (where reviewerID is null) from reviews
        union all select 'reviewText', count(*) filter (where reviewText is null) from reviews
        union all select 'helpfulPos', count(*) filter (where helpfulPos is null) from reviews
        union all select 'helpfulNeg', count(*) filter (where helpfulNeg is null) from reviews
        union all select 'overall', count(*) filter (where overall is null) from reviews""",
    "bad_records": f"""
        {_with(_REVIEWS)}
        select count(*) as records, count(*) filter (where overall > 2) as bad,
          12 * count(*) - count(*) filter (where overall > 2) as fields from reviews""",
    "read_line_corpus": _lines(0, "D"),
    "union_corpora": f"{_lines(0, 'D')} union all {_lines(1, 'T')}",
    "contiguous_index": """
        select doc_id, lang, source,
          row_number() over (order by lang, source desc, doc_id) - 1 as row_index from documents""",
    "contiguous_index_lineitem": """
        select l_orderkey, l_linenumber, l_extendedprice, row_number() over
          (order by l_extendedprice desc, l_orderkey, l_linenumber) - 1 as row_index from lineitem""",
    "running_start": """
        select o_orderkey, o_custkey, cast(coalesce(sum(o_custkey) over
          (order by o_orderkey rows between unbounded preceding and 1 preceding), 0) as bigint)
          as before from orders""",
    "corpus_completeness": """
        with plan("class", expected) as (values ('t', 800::bigint), ('d', 1098::bigint)),
        found as (select case when quality = 1 then 't' else 'd' end c, count(*) n
                  from labels group by 1)
        select "class", coalesce(n, 0) as found, expected, coalesce(n, 0) = expected as ok
        from plan left join found on c = "class" """,
    "class_files_completeness": """
        select case when quality = 1 then 't' else 'd' end as "class",
          count(distinct d.lang) + 1 as files
        from documents d join labels l on d.doc_id = l.doc_id group by 1""",
    "product_star_profile": _profile_query(_REVIEWS, "reviews", "asin", "overall", "pid", "p"),
    "user_star_profile": _profile_query(_REVIEWS, "reviews", "reviewerID", "overall", "uid", "u"),
    "product_star_profile_lineitem": _profile_query(_RATED, "rated", "l_partkey", "rating", "pid", "p"),
    "user_star_profile_lineitem": _profile_query(_RATED, "rated", "l_suppkey", "rating", "uid", "u"),
    "full_outer_merge": f"""
        {_with(_RATED)} select l_partkey, {', '.join(
            f'count(*) filter (where rating = {k}) as n{k}' for k in range(1, 6))},
          count(*) as total from rated group by 1""",
    "user_review_rate": f"{_with(_REVIEWS, _RATE)} select reviewerID, reviewRate from rates",
    "user_review_rate_orders": _rate_query("orders", "o_custkey", "o_orderdate"),
    "user_review_rate_events": _rate_query("events", "user_id", "ts"),
    "top_reviewers_by_rate": f"""
        {_with(_REVIEWS, _RATE)} select reviewerID, reviewRate from rates
        order by reviewRate desc, reviewerID limit 10""",
    "top_reviewers_by_rate_orders": _rate_query("orders", "o_custkey", "o_orderdate")
    + " order by reviewRate desc, o_custkey limit 100",
    "attach_profiles": f"""
        {_with(_REVIEWS, _PROFILES)} select reviewID, asin, helpfulPos, helpfulNeg, overall,
          reviewText, unixReviewTime, reviewerID, p1star, p2star, p3star, p4star, p5star,
          u1star, u2star, u3star, u4star, u5star, label from joined""",
    "attach_profiles_lineitem": f"""
        with lines as (select l_orderkey * 8 + l_linenumber as line, min(l_partkey) as l_partkey,
          min(l_suppkey) as l_suppkey, cast((l_linenumber - 1) % 5 + 1 as double) rating
          from lineitem group by l_orderkey, l_linenumber)
        select line, l_partkey, l_suppkey, rating, {_LINE_STARS} from lines""",
    "text_shape": f"""
        select doc_id, {_word_count('text')} as reviewWordCount,
          {_capital_ratio('text')} as capitalLetterRatio from documents""",
    "text_shape_conversations": f"""
        select conv_id, turn, {_word_count('text')} as reviewWordCount,
          {_capital_ratio('text')} as capitalLetterRatio from conversations""",
    "feature_table": f"{_with(*_REVIEW_FEATURES)} select * from features",
    "features_as_text": f"""
        {_with(*_REVIEW_FEATURES, _FEATURE_TEXT)}
        select reviewID, label, featureText from feature_text""",
    "normalize_text": f"select doc_id, {_normalized('text')} as normalized from documents",
    "normalize_text_lemmas": _lemma_query("select doc_id, text from documents", "doc_id"),
    "normalize_text_lemma_join": _lemma_query(
        "select row_number() over () as doc_id, conv_id, turn, text from conversations",
        "conv_id, turn",
    ),
    "normalize_text_repeated_ids": _lemma_query(
        "select doc_id, case when doc_id % 11 > 0 then doc_id % 10 end as few, text from documents",
        "few",
    ),
    "text_only_frame": f"""
        {_with(_REVIEWS, _TEXTS)} select reviewID, label, txt as text from texts""",
    "text_features_frame": f"""
        {_with(*_REVIEW_FEATURES, _FEATURE_TEXT, _TEXTS)}
        select t.reviewID, t.label, concat(featureText, ' ', txt) as text
        from texts t join feature_text f on t.reviewID = cast(f.reviewID as bigint)""",
    "hashing_tf": f"""
        {_with(_REVIEWS, _TEXTS)}
        select reviewID, cast(len(string_split(txt, ' ')) as bigint) as n_tokens from texts""",
    "term_counts": f"{_with(_REVIEWS, _TEXTS, _COUNTS)} select id, term, tf from counts",
    "document_frequency": f"{_with(_REVIEWS, _TEXTS, _COUNTS)} select term, df from freq",
    "tfidf_terms": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS)}
        select id, term, tf, df, round(weight, 6) as weight from weights""",
    "random_split": f"""
        select doc_id, lang, case when {_IN_TRAIN.format(key='doc_id')} then 'train' else 'test' end
          as part from documents""",
    "cross_validation_folds": f"select doc_id, {_FOLD} as fold from labels",
    "stratified_folds": """
        select doc_id, quality, cast((row_number() over (partition by quality
          order by md5('fold:' || cast(doc_id as varchar)), doc_id) - 1) % 7 as int) as fold
        from labels""",
    "nb_aggregates": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES)}
        select label, term, round(weight_sum, 6) as weight_sum, round(theta, 6) as theta from theta""",
    "nb_priors": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES)}
        select label, n, round(pi, 9) as pi from priors""",
    "nb_predict": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _SCORES)}
        select id, round(max(score) filter (where label = 0), 4) as score0,
          round(max(score) filter (where label = 1), 4) as score1,
          case when max(score) filter (where label = 0) >= max(score) filter (where label = 1)
            then 0.0::double else 1.0::double end as prediction
        from scores group by 1""",
    "nb_predict_unsmoothed": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _UNSMOOTHED)}
        select id, cast(isfinite(score0) as int) + cast(isfinite(score1) as int) as n_finite,
          {_PREDICTED} as prediction from bare_scores""",
    "nb_cv_predictions": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _CV)}
        select id, fold, label, smoothing, prediction from fold_guesses""",
    "nb_cv_relational": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _CV)}
        select smoothing, round(accuracy, 9) as accuracy from grid_accuracy""",
    "nb_cv_metrics": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _CV)},
        chosen as (select b.s, sums.* from sums cross join best b),
        chosen_theta as ({_bayes_at('s', 'chosen', 's')}),
        chosen_priors as (
          select p.label, ln(p.n + b.s) - ln((select sum(n) from priors) + 2 * b.s) pi
          from priors p cross join best b
        ),
        final as (
          select w.id,
            sum(w.weight * t.theta) filter (where t.label = 0) + any_value(p0.pi) score0,
            sum(w.weight * t.theta) filter (where t.label = 1) + any_value(p1.pi) score1
          from weights w join chosen_theta t using (term)
          join chosen_priors p0 on p0.label = 0 join chosen_priors p1 on p1.label = 1
          where not {_IN_TRAIN.format(key='w.id')} group by 1
        ),
        pairs as (
          select r.label truth, {_PREDICTED} guess from final join reviews r on r.reviewID = final.id
        ), {_metrics('pairs', 'truth', 'guess')}
        select m.*, best.s as smoothing from ({_METRIC_ROWS}) m cross join best""",
    "nb_split_metrics": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS, _WEIGHTS, _BAYES, _SCORES)},
        pairs as (
          select any_value(r.label) truth,
            case when max(score) filter (where s.label = 0) >= max(score) filter (where s.label = 1)
              then 0.0::double else 1.0::double end guess
          from scores s join reviews r on r.reviewID = s.id group by s.id
        ), {_metrics('pairs', 'truth', 'guess')} {_METRIC_ROWS}""",
    "classification_metrics": f"with {_metrics('labels', 'quality', 'toxic')} {_METRIC_ROWS}",
    "classification_metrics_languages": f"""
        with pairs as (
          select list_position(['en','de','fr','es'], a.lang) label,
                 list_position(['en','de','fr','es'], b.lang) prediction
          from documents a join documents b on a.doc_id = b.doc_id + 1
        ), {_metrics('pairs', 'label', 'prediction')} {_METRIC_ROWS}""",
    "confusion_matrix": """
        select cast(quality as double) as label, cast(toxic as double) as prediction,
          count(*) as n from labels group by 1, 2""",
    "wssse": """
        with c as (select embedding e from embeddings where vec_id in (0, 1)),
        d as (
          select v.vec_id, min(list_sum(list_transform(range(1, len(c.e) + 1),
            lambda i: pow(v.embedding[i]::double - c.e[i]::double, 2)))) best
          from embeddings v cross join c group by 1
        )
        select count(*) as n, round(sum(best), 6) as wssse from d""",
    "majority_labels": """
        select toxic, cast(arg_min(quality, (-n, quality)) as double) as aligned
        from (select toxic, quality, count(*) n from labels group by 1, 2) group by 1""",
    "string_index": """
        select source as value, count(*) as n,
          cast(row_number() over (order by count(*) desc, source) - 1 as double) as index
        from documents group by 1""",
    "string_index_terms": f"""
        {_with(_REVIEWS, _TEXTS, _COUNTS)} select term as value, df as n,
          cast(row_number() over (order by df desc, term) - 1 as double) as index from freq""",
    "save_model": """
        select doc_id, true as same from documents
        where doc_id not in (select doc_id from labels)""",
    "saved_model_tokens": _lemma_query(
        "select doc_id, text from documents where doc_id not in (select doc_id from labels)", "doc_id"
    ),
    "saved_model_class_counts": f"""
        with lines as ({_lines(0, 'D')} union all {_lines(1, 'T')}),
        fitted as (
          select count(*) n, count(*) filter (where label = 0) n0, count(*) filter (where label = 1) n1
          from lines where {_IN_TRAIN.format(key='id')}
        )
        select (select count(*) from lines) as n_docs,
          round(ln(n0 + 1.0) - ln(n + 2.0), 9) as pi0, round(ln(n1 + 1.0) - ln(n + 2.0), 9) as pi1
        from fitted""",
    "string_index_applied": """
        select d.doc_id, d.source, i.index from documents d join (
          select source, cast(row_number() over (order by count(*) desc, source) - 1 as double) as index
          from documents group by 1) i on i.source = d.source""",
    "string_index_kept": """
        with known as (
          select source, cast(row_number() over (order by count(*) desc, source) - 1 as double) as index
          from documents join labels using (doc_id) where doc_id % 3 = 0 group by 1
        )
        select d.doc_id, d.source,
          coalesce(k.index, cast((select count(*) from known) as double)) as index
        from documents d left join known k on k.source = d.source""",
}
