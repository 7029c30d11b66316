"""DuckDB SQL for the registered queries, on flat rows rather than on JSON."""

from __future__ import annotations

from workload.queries import INSTRUCTION, QNA_TEMPLATE, TOPIC_TEMPLATE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _steps(column: str, steps: list[tuple[str, str]]) -> str:
    for pattern, replacement in steps:
        column = f"regexp_replace({column}, {_text(pattern)}, {_text(replacement)}, 'g')"
    return column


# What the given pages are made of: text in paragraphs that may open with an unclosed bold
# part and a line break, headings, and elements that hold no content.
PAGE_STEPS = [
    (r"(?s)^.*?<body>|<!--.*?-->|<nav>.*?</nav>|<div class=.ad.>.*?</div>|<footer>.*?</footer>", ""),
    (r"\s+", " "),
    (r"([\\`*_\[\]])", r"\\\1"),
    (r" ?<b>([^<]*?) ?<br>", r"**\1**"),
    (r" ?<h1[^>]*> ?", "\n\n# "),
    (r" ?</?(p|h1|li|ul|article|div)\b[^>]*> ?", "\n\n"),
    (r"<[^>]*>", ""),
]
CHARACTERS = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
LINE_STEPS = [(r" *\n *", "\n"), (r"\n\n\n+", "\n\n"), (r"^\s+|\s+$", "")]


def _entities(column: str) -> str:
    for entity, char in CHARACTERS:
        column = f"replace({column}, {_text(entity)}, {_text(char)})"
    return column


def _markdown(column: str) -> str:
    return _steps(_entities(_steps(column, PAGE_STEPS)), LINE_STEPS)


TITLE = f"trim({_entities("regexp_replace(regexp_extract(html, '(?is)<title>([^<]*)</title>', 1), '[ ]+', ' ', 'g')")})"
DESCRIPTION = _entities("""regexp_extract(html, '<meta name="description" content="([^"]*)"', 1)""")
LANGUAGE = """coalesce(nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), ''), 'en')"""
VALID = r"regexp_matches({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]')"
SAFE = (
    "coalesce(nullif(left(translate(replace(replace({0}, 'https://', ''), 'http://', ''), '/?&:=.', '______'), 100), ''),"
    " 'content')"
)
SLUG = r"translate(lower(rtrim(regexp_replace({0}, '[^\p{{L}}\p{{N}} _-]', '', 'g'))), ' -', '__') || '.json'"
STEM = r"regexp_replace({0}, '([^/.][^/]*)\.[^./]*$', '\1')"
PATH = STEM + " || '/' || " + SAFE.replace("{0}", "{1}") + " || '.md'"
WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"

CTE = {
    "q": r"""select conv_id * 1000 + turn as qid, conv_id, turn,
        'Topic ' || case when conv_id % 13 = 0 then '!' else '&' end || ' ' || (conv_id % 7) || ' (L-' || ((conv_id + turn) % 3) || ')' as category,
        text as question,
        case conv_id % 5 when 0 then 'site:example.com' when 1 then 'filetype:html' when 2 then '' end as dorks
        from conversations where role = 'user'""",
    "l": r"""select 'topic__' || (conv_id % 7) || '_l_' || (conv_id % 3) || '/c' || conv_id || '_' || (turn // 64) || '.json' as file_path,
        conv_id, turn, j, category, question, conv_id % 4 = 0 as is_list,
        case when (page_id + turn) % 19 = 0 then replace(url, '://', ':/')
             when page_id % 23 = 0 and conv_id % 2 = 0 then regexp_replace(url, '^(https?://[^/]*)/', '\1_')
             else url end as url,
        conv_id % 4 <> 0 and (page_id + turn + j) % 17 = 0 as is_pdf
        from (select *, unnest(range(10)) as j from q), (select max(page_id) + 1 as n_pages from pages), pages
        where page_id = (conv_id * 31 + (turn * 3 + j * j) % 23) % n_pages""",
    "blocked": r"""select *, case when is_list then turn else min(turn) over (partition by file_path, category) end as first_turn
        from l where conv_id % 41 <> 7 and conv_id % 43 <> 5""",
    "placed": r"""select *, dense_rank() over (partition by file_path order by first_turn) - 1 as entry_pos,
        row_number() over (partition by file_path, first_turn order by turn, j) - 1 as url_pos from blocked""",
    "rec": "select file_path, entry_pos, url_pos, category, question, url, is_pdf from placed where " + VALID.format("url"),
    "ded": """select file_path, url, arg_min(entry_pos, (entry_pos, url_pos)) as entry_pos, arg_min(url_pos, (entry_pos, url_pos)) as url_pos,
        arg_max(category, (entry_pos, url_pos)) as category, arg_max(question, (entry_pos, url_pos)) as question,
        arg_max(is_pdf, (entry_pos, url_pos)) as is_pdf from rec group by file_path, url""",
    "web": "select * from ded where not is_pdf",
    "dim": """select url, min(file_path) as first_file, arg_min(entry_pos, file_path) as entry_pos, arg_min(url_pos, file_path) as url_pos,
        arg_max(category, file_path) as category, arg_max(question, file_path) as question, max(file_path) as input_file
        from web group by url""",
    "scr": r"""select page_id * 2 as item_pos,
        case when page_id % 37 = 5 then '' when page_id % 29 = 3 then url || '/moved' else url end as url,
        case when page_id % 31 = 7 then '' else html end as html from pages
        union all
        select page_id * 2 + 1, regexp_replace(url, '^(https?://[^/]*)/', '\1_'), html from pages where page_id % 23 = 0""",
    "items": "select item_pos, url, html, " + _markdown("html") + " as markdown from scr",
    "meta": """select item_pos,
        case when d.url is null then 'Uncategorized' else d.category end as category,
        case when d.url is null then 'No Question' else d.question end as question,
        """
    + PATH.format("(case when d.url is null then (select min(file_path) from l) else d.input_file end)", "i.url")
    + """ as content_path,
        i.url, 'web' as source_type, 0 as question_count, markdown
        from items i left join dim d on i.url = d.url where markdown <> '' and i.url <> ''""",
    "ex": """select q.conv_id * 1000 + q.turn as prompt_id, q.conv_id % 6 as shape, q.text as q, a.text as a
        from conversations q join conversations a on a.conv_id = q.conv_id and a.turn = q.turn + 1
        where q.role = 'user' and a.role = 'assistant'""",
    "pairs": """select prompt_id, pair_pos, q, a from ex, (select unnest([0, 1]) as pair_pos)
        where prompt_id % 29 <> 0 and (shape in (0, 1, 5)) and (pair_pos = 0 or shape = 5)""",
    "blocks": """select 'c' || conv_id || '_' || (turn // 64) as doc, qid, turn, question,
        row_number() over (partition by conv_id, turn // 64 order by turn) - 1 as block_pos,
        case when qid % 17 = 0 then '' else 'Block ' || ((turn // 2 + conv_id) % 2) end as category from q""",
    "elements": """select *, case q_pos when 0 then question when 1 then question when 2 then 'note ' || qid when 3 then null else '' end as said
        from blocks, (select unnest([0, 1, 2, 3, 4]) as q_pos) where q_pos < 4 or qid % 11 in (0, 1)""",
    "md": "select page_id, url, " + _markdown("html") + " as body from pages",
    "tok": "select page_id, unnest(" + WORDS.format("body") + ") as token from md",
    "post": "select page_id, token, count(*) as tf from tok group by page_id, token",
    "sizes": "select md.page_id, md.url, coalesce(sum(tf), 0)::bigint as n_words from md left join post using (page_id) group by md.page_id, md.url",
    "imp": """select p.token, p.page_id,
        greatest(1, round(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * (1.2::double + 1) / (tf + 1.2::double * ((1 - 0.75::double) + 0.75::double * n_words / mean)) * 10000000000))::bigint as impact
        from post p join sizes using (page_id)
        join (select token, count(*) as df from post group by token) using (token),
        (select count(*) as n, avg(n_words) as mean from sizes)""",
    "mimp": "select token, page_id, 4294967296 + tf as impact from post",
    "places": r"""select page_id, url,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)', 1)) as host,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/[^?#]*\.([A-Za-z0-9]+)(?:[?#]|$)', 1)) as ext from pages""",
    "ans": """select qid as pos, question, case when qid % 9 = 0 then '' else category end as category,
        case when qid % 10 = 3 then 'bad_json' when qid % 10 = 7 then 'no_category' when qid % 9 = 0 then 'empty_category' else 'ok' end as decode_status from q""",
    "cat": "select * from ans where decode_status = 'ok'",
    "firsts": "select category, min(pos) as first_pos from cat group by category",
    "att": """select conv_id as topic_id, turn + 1 as attempt, text as question,
        case (conv_id + turn) % 3 when 0 then 'ok' when 1 then 'empty' else 'bad_json' end as decode_status
        from conversations""",
    "chosen": """select topic_id, min(attempt) filter (decode_status = 'ok') as attempt, count(*) as n_tried from att where attempt <= 5 group by topic_id""",
    "gen": "select topic_id, attempt, question from chosen join att using (topic_id, attempt)",
}


def _sql(names: str, body: str) -> str:
    """A query over the named derivations and those they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        words = CTE[name].replace("(", " ").replace(")", " ").replace(",", " ").split()
        for other in CTE:
            if other != name and other in words and other not in needed and list(CTE).index(other) < list(CTE).index(name):
                add(other)
        if name not in needed:
            needed.append(name)

    for name in names.split():
        add(name)
    ordered = [n for n in CTE if n in needed]
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as materialized ({CTE[n]})" for n in ordered) + "\n" + body


def _asked(query: str, supplied: bool = True, site: str | None = None, filetype: str | None = None) -> str:
    """Queries with their words and the operators that hold for them."""
    where = "" if supplied else " where conv_id % 7 <> 3"
    site_sql = _text(site) if site is not None else "regexp_extract(query, '(?i)(?:^|\\s)site:(\\S+)', 1)"
    type_sql = _text(filetype) if filetype is not None else "regexp_extract(query, '(?i)(?:^|\\s)filetype:(\\S+)', 1)"
    plain = "regexp_replace(query, '(?i)(^|\\s)(?:site|filetype):\\S+', '\\1', 'g')"
    return f"""(select qid, {site_sql} as site, {type_sql} as filetype, unnest(list_distinct({WORDS.format(plain)})) as token
        from (select qid, {query} as query from q{where}))"""


def _ranked(asked: str, k: int, impacts: str = "imp") -> str:
    return f"""select qid, page_id, url, score, rank from (
        select *, row_number() over (partition by qid order by score desc, page_id) as rank from (
        select qid, page_id, any_value(url) as url, sum(impact)::bigint as score
        from {asked} a join {impacts} using (token) join places p using (page_id)
        where (site = '' or host = site or ends_with(host, '.' || site)) and (filetype = '' or ext = filetype)
        group by qid, page_id)) where rank <= {k}"""


EFFECTIVE = "case when coalesce(dorks, '') = '' then question else question || ' ' || dorks end"


def _results() -> str:
    hits = _ranked(_asked(EFFECTIVE, supplied=False), 10)
    return f"""(select qid, category, question, nullif(dorks, '') as dorks, h.rank - 1 as url_pos, h.url,
        case when h.url is null then 'no results found' end as error
        from q left join ({hits}) h using (qid) where conv_id % 7 <> 3
        union all
        select qid, category, question, nullif(dorks, ''), 0, 'https://supplied.example.org/' || conv_id || '/' || turn, null
        from q where conv_id % 7 = 3)"""


def _metadata_fields(prefix: str = "") -> str:
    return ", ".join(prefix + c for c in ("content_path", "question_count", "url", "source_type"))


def all_sql() -> dict[str, str]:
    searched = "q imp places"
    sql = {
        "url_validity": _sql("l", f"select distinct url, {VALID.format('url')} as is_valid from l"),
        "file_status": _sql(
            "l",
            "select distinct file_path, case when conv_id % 41 = 7 then 'invalid_json' when conv_id % 43 = 5 then 'bad_entry' else 'ok' end as status from l",
        ),
        "explode_urls": _sql("rec", "select * from rec"),
        "split_url_files": _sql("rec", "select * from rec"),
        "dedupe_per_file": _sql("ded", "select * from ded"),
        "dedupe_in_documents": _sql("ded", "select * from ded"),
        "web_urls": _sql("web", "select file_path, url from web"),
        "distinct_urls": _sql("dim", "select url, first_file as file_path, entry_pos, url_pos from dim"),
        "url_dimension_last_wins": _sql("dim", "select * from dim"),
        "duplicates_removed": _sql(
            "web",
            "select count(*) as n_urls, count(distinct url) as n_distinct, count(*) - count(distinct url) as n_removed from web",
        ),
        "category_slugs": _sql("q", f"select distinct category, {SLUG.format('category')} as slug from q"),
        "slug_collisions": _sql(
            "q",
            f"select {SLUG.format('category')} as slug, count(distinct category) as n_keys, count(*) as n_rows from q group by 1 having count(distinct category) > 1",
        ),
        "safe_url_names": _sql("l", f"select distinct url, {SAFE.format('url')} as safe_name from l"),
        "content_paths": _sql(
            "l",
            f"select file_path, url, content_path, regexp_extract(content_path, '[^/]*$') as name from (select distinct file_path, url, {PATH.format('file_path', 'url')} as content_path from l)",
        ),
        "path_collisions": _sql(
            "l",
            "select "
            + PATH.format("file_path", "regexp_replace(url, '/[0-9].*$', '')")
            + " as content_path, count(distinct url) as n_keys, count(*) as n_rows from l group by 1 having count(distinct url) > 1",
        ),
        "html_to_markdown": _sql("items", "select item_pos, markdown from items"),
        "page_metadata": _sql(
            "scr", f"""select item_pos, url as "sourceURL", {TITLE} as title, {DESCRIPTION} as description, {LANGUAGE} as language from scr"""
        ),
        "default_metadata": _sql(
            "items",
            f"""select item_pos, case when markdown <> '' then url end as "sourceURL", case when markdown = '' then '' else {TITLE} end as title,
            case when markdown = '' then '' else {DESCRIPTION} end as description, case when markdown = '' then 'en' else {LANGUAGE} end as language from items""",
        ),
        "capture_metadata": _sql("meta", "select * exclude (markdown) from meta"),
        "capture_tally": _sql(
            "items", "select count(*) filter (markdown <> '') as n_success, count(*) filter (markdown = '') as n_failed from items"
        ),
        "unmatched_urls": _sql("dim scr", "select url from dim where url not in (select url from scr)"),
        "stored_documents": _sql(
            "meta",
            """select content_path, item_pos, markdown from (select regexp_replace(content_path, '^.*/|_[0-9].*$', '', 'g') as content_path, item_pos, markdown from meta)
            qualify row_number() over (partition by content_path order by item_pos desc) = 1""",
        ),
        "fetched_pages": _sql(
            "dim md", """select page_id as item_pos, url as "sourceURL", body as markdown from md where url in (select url from dim)"""
        ),
        "capture_summary": _sql(
            "web meta",
            "select (select count(*) from web) as n_extracted, (select count(distinct url) from web) as n_processed, (select count(*) from meta) as n_saved",
        ),
        "metadata_by_category": _sql(
            "meta",
            f"select item_pos, min(item_pos) over (partition by category) as category_pos, category, {_metadata_fields()} from meta",
        ),
        "metadata_blocks": _sql(
            "meta",
            f"""select category, min(item_pos) over (partition by category) as category_pos, item_pos // 32 as block,
            row_number() over (partition by category, item_pos // 32 order by item_pos) - 1 as entry_pos, {_metadata_fields()} from meta""",
        ),
        "aggregated_metadata": _sql(
            "meta pairs",
            """select category, min(item_pos) over (partition by category) as category_pos, item_pos // 4096 as block,
            row_number() over (partition by category, item_pos // 4096 order by item_pos) - 1 as entry_pos,
            content_path, (select count(*) from pairs) as question_count, url, source_type from meta""",
        ),
        "captured_documents": _sql(
            "dim",
            f"""select content_path, item_pos, markdown from (
            select p.page_id as item_pos, {PATH.format('d.input_file', 'p.url')} as content_path, {_markdown('p.html')} as markdown
            from pages p join dim d on d.url = p.url) where markdown <> ''
            qualify row_number() over (partition by content_path order by item_pos desc) = 1""",
        ),
        "question_count_stamp": _sql(
            "meta pairs", "select item_pos, category, content_path, (select count(*) from pairs) as question_count from meta"
        ),
        "first_category_preview": _sql(
            "meta",
            f"select item_pos, category, {_metadata_fields()} from meta where category = (select arg_min(category, item_pos) from meta)",
        ),
        "stage_counts": _sql(
            "l meta pairs",
            """select (select count(*) from l where is_list and conv_id % 41 <> 7 and conv_id % 43 <> 5) as n_urls,
            (select count(distinct content_path) from meta) as n_documents, (select count(*) from pairs) as n_pairs""",
        ),
        "category_block_last_wins": _sql(
            "blocks",
            """select doc, category, min(block_pos) as category_pos, arg_max(4 + (qid % 11 in (0, 1))::int, block_pos) as n_questions
            from blocks group by doc, category""",
        ),
        "question_rejects": _sql(
            "blocks elements",
            """select doc, block_pos, null::int as q_pos, category, 'missing_category' as reject from blocks where category = ''
            union all
            select doc, block_pos, q_pos, category, 'invalid_question' from elements where category <> '' and q_pos = 4 and qid % 11 = 0""",
        ),
        "normalised_unicode": _sql("q", "select qid, nfc_normalize(replace(question, 'é', 'e' || chr(769))) as question from q"),
        "search_query_text": _sql(
            "q",
            """select qid, true as own, coalesce(nullif(dorks, ''), 'site:example.net') as dorks,
            question || ' ' || coalesce(nullif(dorks, ''), 'site:example.net') as query from q
            union all select qid, false, 'site:example.net', question || ' site:example.net' from q""",
        ),
        "supplied_url_bypass": _sql(
            "q", "select qid, 0 as url_pos, 'https://supplied.example.org/' || conv_id || '/' || turn as url from q where conv_id % 7 = 3"
        ),
        "page_words": _sql("post", "select token, page_id, tf, sum(tf) over (partition by page_id)::bigint as n_words from post"),
        "word_frequency": _sql("post", "select token, count(*) as df from post group by token"),
        "bm25_impacts": _sql("imp", "select token, page_id, impact from imp"),
        "corpus_top_k": _sql(searched, "select qid, page_id, score, rank from (" + _ranked(_asked("question"), 10) + ")"),
        "matches_top_k": _sql(
            "q mimp places", "select qid, page_id, score, rank from (" + _ranked(_asked("question"), 5, "mimp") + ")"
        ),
        "dork_site_filter": _sql(
            searched, "select qid, page_id, score, rank from (" + _ranked(_asked("question || ' site:example.org'"), 10) + ")"
        ),
        "dork_filetype_filter": _sql(
            searched,
            "select qid, page_id, score, rank from (" + _ranked(_asked("question", site="example.com", filetype="html"), 10) + ")",
        ),
        "search_results": _sql(searched, f"select qid, category, question, dorks, error, url_pos, url from {_results()}"),
        "retrieved_urls": _sql(searched, f"select qid, category, question, dorks, error, url_pos, url from {_results()}"),
        "results_by_category": _sql(
            searched,
            f"""select category, min(qid) as category_pos, count(distinct qid) as n_results, count(url) as n_urls, count(error) as n_errors
            from {_results()} group by category""",
        ),
        "grouped_results": _sql(
            searched,
            f"""select category, min(qid) over (partition by category) as category_pos, qid // 4096 as block,
            row_number() over (partition by category, qid // 4096 order by qid) - 1 as result_pos, question, dorks, n_urls, error
            from (select qid, category, question, dorks, error, count(url) as n_urls from {_results()} group by all)""",
        ),
        "two_engine_union": _sql(
            "q imp mimp places",
            f"""select 'bm25' as engine, qid, rank - 1 as url_pos, url from ({_ranked(_asked("question"), 5)})
            union all select 'matches', qid, rank - 1, url from ({_ranked(_asked("question"), 5, "mimp")})""",
        ),
        "qna_prompts": _sql(
            "meta",
            f"""select content_path, {_text(QNA_TEMPLATE.replace("{domain_of_expertise}", "Software Engineering"))} || chr(10) || markdown as prompt,
            length(markdown) as n_chars from meta qualify row_number() over (partition by content_path order by item_pos desc) = 1""",
        ),
        "decode_status": _sql(
            "ex",
            """select prompt_id, case when prompt_id % 29 = 0 then 'no_reply' when shape in (0, 1, 5) then 'ok' when shape = 2 then 'bad_json'
            when shape = 3 then 'no_list' else 'no_response' end as decode_status from ex""",
        ),
        "decode_qna": _sql("pairs", "select * from pairs"),
        "prompts_with_replies": _sql(
            "ex",
            """select prompt_id, case when prompt_id % 29 = 0 then 'no_reply' when shape in (0, 1, 5) then 'ok' when shape = 2 then 'bad_json'
            when shape = 3 then 'no_list' else 'no_response' end as decode_status,
            case when prompt_id % 29 = 0 then 0 when shape in (0, 1) then 1 when shape = 5 then 2 else 0 end as n_pairs from ex""",
        ),
        "topic_prompts": _sql(
            "q", f"select distinct category as topic, replace({_text(TOPIC_TEMPLATE)}, '{{topic}}', category) as prompt from q"
        ),
        "attempt_status": _sql("att", "select topic_id, attempt, decode_status from att"),
        "first_good_attempt": _sql(
            "chosen att",
            "select topic_id, attempt, n_tried, question as first_question from chosen left join att using (topic_id, attempt)",
        ),
        "exhausted_topics": _sql("chosen", "select topic_id, n_tried from chosen where attempt is null"),
        "generated_questions": _sql("gen", "select topic_id, attempt, 0 as q_pos, question from gen"),
        "category_reply_status": _sql("ans", "select pos, decode_status from ans"),
        "running_categories": _sql(
            "ans firsts", "select pos, (select count(*) from firsts where first_pos < pos) as n_existing from ans"
        ),
        "category_vocabulary": _sql("firsts", "select category, row_number() over (order by first_pos) - 1 as category_pos from firsts"),
        "categorisation_prompts": _sql(
            "ans firsts",
            f"""select pos, n_existing, {_text(f"Instruction: {INSTRUCTION} Question: ")} || question || chr(10) || 'Existing categories: ['
            || coalesce(known, '') || ']' as prompt from (select pos, question,
            (select count(*) from firsts where first_pos < pos) as n_existing,
            (select string_agg('''' || category || '''', ', ' order by first_pos) from firsts where first_pos < pos) as known from ans)""",
        ),
        "categorise_fold": _sql("cat", "select pos, category, question, min(pos) over (partition by category) as category_pos from cat"),
        "categorised_blocks": _sql(
            "cat",
            """select category, min(pos) over (partition by category) as category_pos, pos // 4096 as block,
            row_number() over (partition by category, pos // 4096 order by pos) - 1 as q_pos, question from cat""",
        ),
        "categorisation_counts": _sql(
            "ans",
            "select count(*) as n_questions, count(distinct category) filter (decode_status = 'ok') as n_categories from ans",
        ),
        "generated_and_categorised": _sql(
            "gen",
            """select 'c' || (topic_id % 7) as category, min(topic_id) over (partition by topic_id % 7) as category_pos,
            topic_id as pos, 'q' || topic_id as question from gen""",
        ),
        "url_files_roundtrip": _sql(
            "l",
            f"""select regexp_replace({SLUG.format('category')}, '\\.json$', '') as slug, conv_id * 1000 + turn as qid, category, question, j as url_pos, url
            from l where category in (select arg_max(category, first_seen) from
            (select category, {SLUG.format('category')} as slug, min(conv_id * 1000 + turn) as first_seen from l group by 1, 2) group by slug)""",
        ),
        "categories_searched_again": _sql(
            "q",
            f"""select slug, qid, category, question, dorks, error from (
            with runs as (
                select 1 as run, *, null as error from q union all select 2, *, 'searched again' from q where dorks <> ''),
            named as (select *, regexp_replace({SLUG.format('category')}, '\\.json$', '') as slug from runs),
            firsts as (select run, slug, category, min(qid) as first_seen from named group by all),
            winners as (select run, slug, arg_max(category, first_seen) as category from firsts group by run, slug)
            select * from named join winners using (run, slug, category) qualify run = max(run) over (partition by slug))""",
        ),
        "written_metadata": _sql(
            "meta",
            f"""select category, min(item_pos) over (partition by category) as category_pos, item_pos // 4096 as block,
            row_number() over (partition by category, item_pos // 4096 order by item_pos) - 1 as entry_pos, {_metadata_fields()} from meta""",
        ),
        "written_pairs": _sql("pairs", "select q, a from pairs"),
        "written_questions": _sql("gen", "select question from gen"),
        "markdown_files_roundtrip": _sql(
            "items", "select 'd' || item_pos || '.md' as content_path, markdown from items where markdown <> ''"
        ),
    }
    for name, start in (("questions_list_form", "category <> '' and "), ("questions_map_form", "")):
        sql[name] = _sql(
            "elements",
            f"""select doc, category, category_pos, q_pos, said as question, case when q_pos = 1 then 'site:a.b' end as dorks,
            case when q_pos = 1 then 2 end as n_urls, case when q_pos = 1 then 'http://a.b/' || qid end as first_url
            from elements join (select doc, category, min(block_pos) as category_pos, max(block_pos) as block_pos from elements group by 1, 2)
            using (doc, category, block_pos) where {start}not (q_pos = 4 and qid % 11 = 0)""",
        )
    sql["raw_questions"] = _sql(
        "elements",
        """select doc, category, category_pos, q_pos, question from elements
        join (select doc, category, min(block_pos) as category_pos, max(block_pos) as block_pos from elements group by 1, 2)
        using (doc, category, block_pos) where q_pos = 0""",
    )
    sql["harvest_urls"] = _sql(
        "l",
        f"select conv_id * 1000 + turn as doc, 2 * j as value_pos, url from l where {VALID.format('url')}",
    )
    sql["harvest_urls_pdf"] = _sql(
        "l",
        f"""select conv_id * 1000 + turn as doc, 3 * j + step as value_pos, url, case when step = 0 then is_pdf else false end as is_pdf
        from l, (select unnest([0, 1]) as step) where {VALID.format('url')}""",
    )
    sql["harvest_status"] = _sql(
        "l", "select distinct file_path as doc, case when conv_id % 41 = 7 then 'invalid_json' else 'ok' end as status from l"
    )
    run = f"""res as materialized (select *, {SLUG.format('category')} as slug from {_results()}),
        kept as materialized (select * from res where category in (select arg_max(category, first_seen) from
            (select category, slug, min(qid) as first_seen from res group by 1, 2) group by slug) and url is not null),
        last as (select url, max(slug) as slug from kept group by url),
        doc as (select p.page_id, p.url, {PATH.format('slug', 'p.url')} as path from last join pages p using (url)),
        saved as (select path, max(page_id) as page_id, arg_max(url, page_id) as url from doc group by path)"""
    sql["end_to_end_counts"] = _sql(
        searched,
        f"""select n_urls, n_documents, n_pairs from (with {run} select (select count(*) from kept) as n_urls,
        (select count(*) from saved) as n_documents, (select count(*) from saved) as n_pairs)""",
    )
    sql["end_to_end_pairs"] = _sql(
        searched,
        f"""select content_path, prompt_id, pair_pos, q, a from (with {run}
        select path as content_path, page_id as prompt_id, 0 as pair_pos, url as q, url as a from saved)""",
    )
    sql["recorded_replies"] = sql["decode_status"]
    sql["questions_normalised_unicode"] = sql["questions_list_form"]
    sql["corpus_top_k_by_floor"] = sql["corpus_top_k"]
    return sql
