"""Inputs for the registered queries, derived row by row from the given tables.

The given texts hold no markdown, so guides, tables, lists, nested bullets and site pages
are written around the text of each document, and model answers hold its sentences as turns. No input groups rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITES = (
    "CASE doc_id % 8 WHEN 1 THEN 'https://www.blackdesertfoundry.com/guide/' "
    "WHEN 5 THEN 'https://www.blackdesertfoundry.com/guide/' "
    "WHEN 2 THEN 'https://garmoth.com/guides/post/' WHEN 6 THEN 'https://garmoth.com/guides/post/' "
    "WHEN 7 THEN 'https://guides.example.org/' "
    "ELSE 'https://www.naeu.playblackdesert.com/wiki/' END || doc_id"
)


# A table of one row group is one task however many cores there are. A session that reads such tables may set
# this to a number of partitions, over which rows are then dealt; without it scans are never moved.
SPREAD = "corpusloom.spread.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table, dealt by `spread_by` if the session asks for it."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    partitions = spark.conf.get(SPREAD, None)
    return rows.repartition(int(partitions), spread_by) if spread_by and partitions else rows


def _documents(spark: SparkSession, sf_dir: str, content: str, *, url: bool = False) -> DataFrame:
    columns = ["doc_id"] + ([f"{SITES} AS url"] if url else []) + [f"{content} AS content"]
    return table(spark, sf_dir, "documents", "doc_id").selectExpr(*columns)


_SENTENCES = (
    "filter(transform(split(replace(replace(text, '\\n', ' '), '|', '/'), '[.] '), x -> trim(x)), x -> x <> '')"
)


def guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every line of a document under one of four heading forms, or none."""
    section = (
        "concat(CASE i % 5 WHEN 0 THEN concat('## Part ', i) WHEN 1 THEN concat('### Part ', i) "
        "WHEN 2 THEN concat('Part ', i, '\\n------') WHEN 3 THEN concat(i, '. Part\\n\\n***') "
        "ELSE 'No heading here.' END, '\\n\\n', line)"
    )
    return _documents(
        spark,
        sf_dir,
        "concat(CASE WHEN doc_id % 3 = 2 THEN '' ELSE concat('# Guide ', doc_id, '\\n\\n') END, "
        "CASE WHEN doc_id % 2 = 0 THEN 'Short opening.' ELSE repeat('Long opening words. ', 12) END, '\\n\\n', "
        f"array_join(transform(split(text, '\\n'), (line, i) -> {section}), '\\n\\n'))",
        url=True,
    )


TABLE_MD = (
    "concat('## Facts of ', doc_id, '\\n', "
    "CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '\\n' ELSE '**Facts**\\n' END, "
    "'| No | Text |\\n|:---|---|\\n', "
    f"array_join(transform({_SENTENCES}, (s, i) -> concat('| ', i + 1, ' | ', s, ' |')), '\\n'), "
    "CASE WHEN doc_id % 2 = 1 THEN '\\n\\nClosing words.' ELSE '' END)"
)
LIST_MD = (
    "concat('## List of ', doc_id, '\\n\\nOpening words.\\n\\n', "
    f"array_join(transform({_SENTENCES}, (s, i) -> concat("
    "CASE doc_id % 3 WHEN 0 THEN '* ' WHEN 1 THEN '- ' ELSE concat(i + 1, '. ') END, s, "
    "CASE WHEN i % 4 = 3 THEN '\\n  more words' ELSE '' END)), '\\n'))"
)
NESTED_MD = (
    "concat('## Lines of ', doc_id, '\\n', "
    "CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '\\n' ELSE '**Lines**\\n' END, "
    "array_join(transform(split(text, '\\n'), (line, i) -> concat('* Line ', i + 1, "
    "array_join(transform(filter(split(line, '[.] '), x -> trim(x) <> ''), s -> concat('\\n  * ', trim(s))), ''))), '\\n'), "
    "CASE WHEN doc_id % 2 = 1 THEN '\\n\\nClosing words.\\n* Last' ELSE '' END)"
)


def tables_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every sentence a table row."""
    return _documents(spark, sf_dir, TABLE_MD)


def lists_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every sentence a list item."""
    return _documents(spark, sf_dir, LIST_MD)


def nested_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every line a bullet with its sentences nested."""
    return _documents(spark, sf_dir, NESTED_MD)


def structures_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the three forms, or the bare text, per document."""
    return _documents(
        spark,
        sf_dir,
        f"CASE doc_id % 4 WHEN 0 THEN {TABLE_MD} WHEN 1 THEN {LIST_MD} WHEN 2 THEN {NESTED_MD} ELSE text END",
    )


WIKI_PAGE = (
    "concat('### Guide ', doc_id, ' Request Edit\\nLast Edited on : Jan ', doc_id % 28 + 1, "
    "', 2024 at noon Share\\nCopy URL Facebook X\\n\\n', text, '\\n\\n\\n\\nEnd.\\n', "
    "CASE doc_id % 32 WHEN 0 THEN '_The content of the game guide may differ from the actual game content._\\nmore' "
    "WHEN 4 THEN '### Request Edit\\nmore' WHEN 8 THEN 'Share\\nFacebook\\nTwitter' WHEN 12 THEN 'Share\\nnothing else' "
    "WHEN 16 THEN '[a](https://x.example/a)\\n[b](https://x.example/b)\\n[c](https://x.example/c)\\nmore' "
    "WHEN 20 THEN '[a](https://x.example/a)\\nmore' "
    "WHEN 24 THEN '[![Image 9: PEGI 16](https://x.example/p.png)](https://x.example/p)\\nmore' "
    "ELSE 'Facebook\\nSend Request to Update\\nTwitter' END)"
)
BLOG_PAGE = (
    "concat('Title: Guide ', doc_id, ' - BDFoundry\\nDescription: words\\nSkip to content\\n\\n', "
    "'**Last Updated:** Feb ', doc_id % 28 + 1, ', 2024 | by someone\\n\\n', 'You are here: Home > ', doc_id, '\\n\\n', "
    "CASE doc_id % 3 WHEN 0 THEN 'Introduction\\n------------\\n\\n' WHEN 1 THEN '## Introduction\\n\\n' ELSE '# Words\\n\\n' END, "
    "text, '\\n\\n#### Quick Links\\n* one\\n* two\\n\\n## More\\n\\nwords\\n\\n', "
    "CASE doc_id % 5 WHEN 0 THEN '[By Someone](https://x.example/s) on Monday\\nmore' "
    "WHEN 1 THEN '### Check these out before you go!\\nmore' "
    "WHEN 2 THEN 'The content of the game guide may differ from the actual game content.' ELSE 'last words' END)"
)
TOOL_PAGE = (
    "concat('Guide ', doc_id, ' | Guide | Garmoth.com - BDO Companion\\n\\nmenu\\n![cover](https://x.example/c.png) By Someone\\n', "
    "'Updated: Mar ', doc_id % 28 + 1, ', 2024 | 5 min\\n\\n', "
    "CASE doc_id % 3 WHEN 0 THEN '1.  Introduction\\n\\n' WHEN 1 THEN '### Introduction\\n\\n' ELSE '' END, "
    "text, CASE WHEN doc_id % 5 < 3 THEN '\\n\\n**Did we miss a thing? Let us know!**\\nmore' ELSE '\\n\\nlast words' END)"
)
PLAIN_PAGE = "concat('[Home](https://x.example/)\\n\\n\\n', text, '\\n\\n[More](https://x.example/m) words\\n')"


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents inside the boilerplate of the three site forms; some without it."""
    return _documents(
        spark,
        sf_dir,
        f"CASE WHEN doc_id % 4 = 0 THEN {WIKI_PAGE} WHEN doc_id % 4 = 1 THEN {BLOG_PAGE} "
        f"WHEN doc_id % 4 = 2 THEN {TOOL_PAGE} ELSE {PLAIN_PAGE} END",
        url=True,
    )


def html_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as HTML: headings, an ordered list, nested lists, a link in single quotes, references, a rule."""
    escaped = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    inner = (
        "array_join(transform(filter(split(line, '[.] '), x -> trim(x) <> ''), "
        f"s -> concat('<li>', {escaped.format('trim(s)')})), '')"
    )
    return table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id",
        "concat('<h', 2 + doc_id % 5, '>Doc ', doc_id, '</h', 2 + doc_id % 5, '>\\n<OL class=x>', "
        f"array_join(transform({_SENTENCES}, s -> concat('<li>', {escaped.format('s')}, '</li>')), ' '), '</ol><ul>', "
        f"array_join(transform(split(text, '\\n'), line -> concat('<li><p>Line<ul>', {inner}, '</ul></li>')), ''), "
        "'</ul><p><a href=\\'https://x.example/', doc_id, '\\'>A &eacute;&#x27;&#08364; link</a></p><hr>') AS html",
    )


def html_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of a document as an ordered list inside one to eight lists, ordered and not in turn, in a cell of a table."""
    escaped = "replace(replace(replace(s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    tag = "IF(k % 2 = 0, 'ol', 'ul')"
    inner = f"concat('<ol>', array_join(transform({_SENTENCES}, s -> concat('<li>', {escaped})), ''), '</ol>')"
    nested = (
        f"aggregate(reverse(sequence(1, CAST(doc_id % 8 + 1 AS int))), {inner}, (html, k) -> "
        f"concat('<', {tag}, '>\n<li>Level ', k, html, '</li> <li><p>After ', k, '</li></', {tag}, '>'))"
    )
    return table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id",
        f"concat('<p>Doc ', doc_id, '</p>', {nested}, '<p>End</p><table><tr><td>', doc_id, "
        "'<td><table><tr><th>in<td><TABLE><tr><td>most</table></table></td></tr></table>') AS html",
    )


def link_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: a small link file per page, with repeats, images and titles."""
    return table(spark, sf_dir, "pages").selectExpr(
        "concat('links_', page_id, '.md') AS file",
        "concat('# Links\\n\\n- [Page ', page_id, '](', url, ')\\n- ![shot](', url, '.png)\\n', "
        "'- [again](', url, ' \"A title\")\\n- plain ', url, '\\n- [host](', regexp_extract(url, '^(https?://[^/]+/)', 1), ')\\n', "
        "'[over\\nlines](https://shared.example/', page_id % 10, ')') AS text",
    )


def ingested_pages(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """URLs of the pages with ingest times, as they come in four runs: url, ingest_time.

    First all of them; then half of them again two hours later, which are repeats; three days later other URLs, which move the
    watermark; then a third of the first ones again, new by then, and others from the second day, which are too late.
    """
    minute = "make_interval(0, 0, 0, {}, 0, length(url) % 60)"
    at = f"TIMESTAMP_LTZ '2024-01-01 00:00:00 UTC' + {minute}"
    pages = table(spark, sf_dir, "pages").where("url IS NOT NULL")

    def run(days: int, url: str = "url", where: str = "true", hours: int = 0) -> DataFrame:
        time = f"{at.format(days)} + make_interval(0, 0, 0, 0, {hours})"
        return pages.where(where).selectExpr(f"{url} AS url", f"{time} AS ingest_time")

    again = run(3, where="length(url) % 3 = 0", hours=1)
    late = run(1, "concat(url, '#late')", "length(url) % 3 = 1")
    return [run(0), run(0, where="length(url) % 2 = 0", hours=2), run(3, "concat(url, '#other')"), again.unionByName(late)]


def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from the pages: their hosts and the ends of their URLs, with repeated domains and priorities."""
    return table(spark, sf_dir, "pages").selectExpr(
        "stack(2, 'clean', page_id % 7, regexp_extract(url, '^https?://([^/]+)', 1), concat('host ', page_id % 5), "
        "'fetch', page_id % 11, right(url, 4), concat('end ', page_id % 3)) AS (stage, priority, domain, strategy)"
    )


def state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines of a state file, some padded, some blank."""
    return table(spark, sf_dir, "pages").selectExpr(
        "CASE page_id % 3 WHEN 0 THEN concat('  ', url, ' ') WHEN 1 THEN '' ELSE '\\t' END AS value"
    )


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page HTML as stored fetch responses of four shapes."""
    quoted = "replace(replace(replace(replace(html, '\\\\', '\\\\\\\\'), '\"', '\\\\\"'), '\\n', '\\\\n'), '\\t', '\\\\t')"
    inner = f"concat('{{\"title\":\"T', page_id, '\",\"url\":\"', url, '?r\",\"content\":\"', {quoted}, '\"}}')"
    return table(spark, sf_dir, "pages", "page_id").selectExpr(
        "page_id",
        "url",
        "CASE page_id % 4 WHEN 0 THEN 'text' WHEN 3 THEN 'converter' ELSE 'reader' END AS kind",
        f"CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN concat('{{\"data\":', {inner}, '}}') "
        f"WHEN 2 THEN {inner} ELSE concat('{{\"markdown\":\"', {quoted}, '\"}}') END AS raw",
    )


def _json_text(column: str) -> str:
    return (
        f"concat('\"', replace(replace(replace(replace({column}, '\\\\', '\\\\\\\\'), '\"', '\\\\\"'), "
        "'\\n', '\\\\n'), '\\t', '\\\\t'), '\"')"
    )


def dialogues_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a JSON dialogue, its sentences said in turn: doc_id, dialogue."""
    entry = f"concat('{{\"role\":\"', IF(i % 2 = 0, 'user', 'assistant'), '\",\"content\":', {_json_text('s')}, '}}')"
    return table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id",
        f"concat('{{\"conversations\":[', array_join(transform({_SENTENCES}, (s, i) -> {entry}), ','), "
        "'],\"topic\":', doc_id, '}') AS dialogue",
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given conversations, one turn per row."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def responses(spark: SparkSession, sf_dir: str, attempts: int = 1) -> DataFrame:
    """dialogues as model answers, well-formed or not; a second attempt is well-formed."""
    shaped = (
        "CASE doc_id % 8 WHEN 0 THEN concat('[', dialogue, ']') "
        "WHEN 1 THEN concat('```json\\n[', dialogue, ',', dialogue, ']\\n```') "
        "WHEN 2 THEN concat('```\\n[', dialogue, ']\\n```') "
        "WHEN 3 THEN concat(dialogue, '\\nnoise\\n', dialogue, '\\n{\"conversations\":[]}') "
        "WHEN 4 THEN dialogue "
        "WHEN 5 THEN concat('[', replace(dialogue, '. ', '.\\\\* '), ']') "
        "WHEN 6 THEN substring(concat('[', dialogue, ']'), 1, length(dialogue) - 10) "
        "ELSE '[{\"conversations\":[{\"role\":\"user\",\"content\":\"x\"}]},"
        "{\"conversations\":[{\"role\":\"user\",\"content\":\"x\"},{\"role\":\"assistant\"}]}]' END"
    )
    base = dialogues_json(spark, sf_dir)
    request = "concat('r', doc_id) AS request_id"
    tries = [base.selectExpr(request, "1 AS attempt", f"{shaped} AS raw")]
    if attempts > 1:
        tries.append(base.selectExpr(request, "2 AS attempt", "concat('[', dialogue, ']') AS raw"))
    return tries[0] if len(tries) == 1 else tries[0].unionByName(tries[1])


def mixed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a dialogue object with nested, repeated and unordered keys: request_id, attempt, raw."""
    said = f"concat('{{\"content\":', {_json_text('s')}, ',\"role\":\"', IF(i % 2 = 0, 'user', 'assistant'), '\"}}')"
    return table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "concat('r', doc_id) AS request_id",
        "1 AS attempt",
        "concat('{\"z\":{\"b\":', doc_id, ',\"a\":[true,null,{\"y\":NaN,\"x\":1.50}]},\"topic\":\"first\",\"url\":\"old\",', "
        f"'\"conversations\":[', array_join(transform({_SENTENCES}, (s, i) -> {said}), ','), "
        "'],\"b\":\"\\u00e9\",\"a\":[],\"topic\":{\"k\":', doc_id, ',\"k\":-', doc_id, '.0}}') AS raw",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each request came from: request_id, url, date, guide_title, prompt. Every third is listed twice."""
    rows = table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "concat('r', doc_id) AS request_id",
        "concat('https://guides.example.org/', doc_id % 40) AS url",
        "CASE WHEN doc_id % 2 = 0 THEN 'Jan 5, 2024' ELSE '' END AS date",
        "concat('Guide ', doc_id % 40) AS guide_title",
        "concat('Ask about ', doc_id, '\\n', text) AS prompt",
        "explode(sequence(0, IF(doc_id % 3 = 0, 1, 0))) AS again",
    )
    return rows.drop("again")
