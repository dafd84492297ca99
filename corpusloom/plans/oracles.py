"""DuckDB SQL for the registered queries, over the same tables.

Written apart from the operators: lines are rows, sections are running sums, packing is a
recursive CTE. Patterns keep to what a regex engine without look-around can do.
"""

from __future__ import annotations

import re

from corpusloom import fixed_values as fv

WS = "'" + fv.WHITESPACE + "'"
WORD = r"'[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {WORD}))"


def tokens(x: str) -> str:
    return f"({words(x)} * 13 // 10)"


def chain(x: str, steps) -> str:
    for pattern, replacement in steps:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"
    return x


# ---- rendered inputs -------------------------------------------------------------------

URL = """concat(CASE doc_id % 8 WHEN 1 THEN 'https://www.blackdesertfoundry.com/guide/'
  WHEN 5 THEN 'https://www.blackdesertfoundry.com/guide/'
  WHEN 2 THEN 'https://garmoth.com/guides/post/' WHEN 6 THEN 'https://garmoth.com/guides/post/'
  WHEN 7 THEN 'https://guides.example.org/' ELSE 'https://www.naeu.playblackdesert.com/wiki/' END, doc_id)"""
SENTENCES = r"""list_filter(list_transform(string_split(replace(replace(text, E'\n', ' '), '|', '/'), '. '),
  lambda x: trim(x)), lambda x: x <> '')"""

GUIDES = rf"""guides AS (SELECT doc_id, {URL} AS url, concat(
  CASE WHEN doc_id % 3 = 2 THEN '' ELSE concat('# Guide ', doc_id, E'\n\n') END,
  CASE WHEN doc_id % 2 = 0 THEN 'Short opening.' ELSE repeat('Long opening words. ', 12) END, E'\n\n',
  array_to_string(list_transform(string_split(text, E'\n'), lambda line, k: concat(
    CASE (k - 1) % 5 WHEN 0 THEN concat('## Part ', k - 1) WHEN 1 THEN concat('### Part ', k - 1)
      WHEN 2 THEN concat('Part ', k - 1, E'\n------') WHEN 3 THEN concat(k - 1, E'. Part\n\n***')
      ELSE 'No heading here.' END, E'\n\n', line)), E'\n\n')) AS content FROM documents)"""
TABLE_MD = rf"""concat('## Facts of ', doc_id, E'\n',
  CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN E'\n' ELSE E'**Facts**\n' END, E'| No | Text |\n|:---|---|\n',
  array_to_string(list_transform({SENTENCES}, lambda s, k: concat('| ', k, ' | ', s, ' |')), E'\n'),
  CASE WHEN doc_id % 2 = 1 THEN E'\n\nClosing words.' ELSE '' END)"""
LIST_MD = rf"""concat('## List of ', doc_id, E'\n\nOpening words.\n\n',
  array_to_string(list_transform({SENTENCES}, lambda s, k: concat(
    CASE doc_id % 3 WHEN 0 THEN '* ' WHEN 1 THEN '- ' ELSE concat(k, '. ') END, s,
    CASE WHEN k % 4 = 0 THEN E'\n  more words' ELSE '' END)), E'\n'))"""
NESTED_MD = r"""concat('## Lines of ', doc_id, E'\n',
  CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN E'\n' ELSE E'**Lines**\n' END,
  array_to_string(list_transform(string_split(text, E'\n'), lambda line, k: concat('* Line ', k,
    array_to_string(list_transform(list_filter(string_split(line, '. '), lambda s: trim(s) <> ''),
      lambda s: concat(E'\n  * ', trim(s))), ''))), E'\n'),
  CASE WHEN doc_id % 2 = 1 THEN E'\n\nClosing words.\n* Last' ELSE '' END)"""
STRUCTURES_MD = (
    f"CASE doc_id % 4 WHEN 0 THEN {TABLE_MD} WHEN 1 THEN {LIST_MD} WHEN 2 THEN {NESTED_MD} ELSE text END"
)


def md(name: str, content: str) -> str:
    return f"{name} AS (SELECT doc_id, {content} AS content FROM documents)"


WIKI_PAGE = r"""concat('### Guide ', doc_id, E' Request Edit\nLast Edited on : Jan ', doc_id % 28 + 1,
  E', 2024 at noon Share\nCopy URL Facebook X\n\n', text, E'\n\n\n\nEnd.\n',
  CASE doc_id % 32 WHEN 0 THEN E'_The content of the game guide may differ from the actual game content._\nmore'
    WHEN 4 THEN E'### Request Edit\nmore' WHEN 8 THEN E'Share\nFacebook\nTwitter' WHEN 12 THEN E'Share\nnothing else'
    WHEN 16 THEN E'[a](https://x.example/a)\n[b](https://x.example/b)\n[c](https://x.example/c)\nmore'
    WHEN 20 THEN E'[a](https://x.example/a)\nmore'
    WHEN 24 THEN E'[![Image 9: PEGI 16](https://x.example/p.png)](https://x.example/p)\nmore'
    ELSE E'Facebook\nSend Request to Update\nTwitter' END)"""
BLOG_PAGE = r"""concat('Title: Guide ', doc_id, E' - BDFoundry\nDescription: words\nSkip to content\n\n',
  '**Last Updated:** Feb ', doc_id % 28 + 1, E', 2024 | by someone\n\n', 'You are here: Home > ', doc_id, E'\n\n',
  CASE doc_id % 3 WHEN 0 THEN E'Introduction\n------------\n\n' WHEN 1 THEN E'## Introduction\n\n' ELSE E'# Words\n\n' END,
  text, E'\n\n#### Quick Links\n* one\n* two\n\n## More\n\nwords\n\n',
  CASE doc_id % 5 WHEN 0 THEN E'[By Someone](https://x.example/s) on Monday\nmore'
    WHEN 1 THEN E'### Check these out before you go!\nmore'
    WHEN 2 THEN 'The content of the game guide may differ from the actual game content.' ELSE 'last words' END)"""
TOOL_PAGE = r"""concat('Guide ', doc_id, E' | Guide | Garmoth.com - BDO Companion\n\nmenu\n![cover](https://x.example/c.png) By Someone\n',
  'Updated: Mar ', doc_id % 28 + 1, E', 2024 | 5 min\n\n',
  CASE doc_id % 3 WHEN 0 THEN E'1.  Introduction\n\n' WHEN 1 THEN E'### Introduction\n\n' ELSE '' END,
  text, CASE WHEN doc_id % 5 < 3 THEN E'\n\n**Did we miss a thing? Let us know!**\nmore' ELSE E'\n\nlast words' END)"""
PLAIN_PAGE = r"concat(E'[Home](https://x.example/)\n\n\n', text, E'\n\n[More](https://x.example/m) words\n')"
SITES = f"""sites AS (SELECT doc_id, {URL} AS url, CASE doc_id % 4 WHEN 0 THEN {WIKI_PAGE} WHEN 1 THEN {BLOG_PAGE}
  WHEN 2 THEN {TOOL_PAGE} ELSE {PLAIN_PAGE} END AS content FROM documents)"""

LINK_FILES = r"""link_files AS (SELECT concat('links_', page_id, '.md') AS file, concat(E'# Links\n\n- [Page ', page_id, '](', url,
  E')\n- ![shot](', url, E'.png)\n', '- [again](', url, E' "A title")\n- plain ', url, E'\n- [host](',
  regexp_extract(url, '^(https?://[^/]+/)', 1), E')\n', E'[over\nlines](https://shared.example/', page_id % 10, ')') AS text FROM pages)"""
STATE = r"""state AS (SELECT CASE page_id % 3 WHEN 0 THEN concat('  ', url, ' ') WHEN 1 THEN '' ELSE E'\t' END AS value FROM pages)"""


def json_text(x: str) -> str:
    return (
        rf"""concat('"', replace(replace(replace(replace({x}, '\', '\\'), '"', '\"'), E'\n', '\n'), E'\t', '\t'), '"')"""
    )


DIALOGUES = rf"""base AS (SELECT doc_id AS conv_id, concat('{{"conversations":[',
  array_to_string(list_transform({SENTENCES}, lambda s, k: concat('{{"role":"', CASE k % 2 WHEN 1 THEN 'user' ELSE 'assistant' END,
    '","content":', {json_text('s')}, '}}')), ','), '],"topic":', doc_id, '}}') AS dialogue, len({SENTENCES}) AS n_turns FROM documents)"""
RESPONSES = DIALOGUES + r""", responses AS (SELECT concat('r', conv_id) AS request_id, 1::BIGINT AS attempt,
  CASE conv_id % 8 WHEN 0 THEN concat('[', dialogue, ']')
    WHEN 1 THEN concat(E'```json\n[', dialogue, ',', dialogue, E']\n```')
    WHEN 2 THEN concat(E'```\n[', dialogue, E']\n```')
    WHEN 3 THEN concat(dialogue, E'\nnoise\n', dialogue, E'\n{"conversations":[]}')
    WHEN 4 THEN dialogue
    WHEN 5 THEN concat('[', replace(dialogue, '. ', '.\* '), ']')
    WHEN 6 THEN substring(concat('[', dialogue, ']'), 1, length(dialogue) - 10)
    ELSE '[{"conversations":[{"role":"user","content":"x"}]},{"conversations":[{"role":"user","content":"x"},{"role":"assistant"}]}]'
  END AS raw, dialogue, n_turns FROM base)"""
REQUESTS = r"""requests AS (SELECT concat('r', doc_id) AS request_id,
  concat('https://guides.example.org/', doc_id % 40) AS url,
  CASE WHEN doc_id % 2 = 0 THEN 'Jan 5, 2024' ELSE '' END AS date,
  concat('Ask about ', doc_id, E'\n', text) AS prompt FROM documents)"""

# ---- HTML, titles, plain text ----------------------------------------------------------


def markdown_of(html: str) -> str:
    x = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "noscript", "title", "nav", "footer"):
        x = rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"
    x = rf"regexp_replace({x}, '\s+', ' ', 'g')"
    x = chain(
        x,
        [
            (r"(?i)<img\b[^>]*?\bsrc=\"([^\"]*)\"[^>]*>".replace(r"\"", '"'), r"![](\1)"),
            (r"(?is)<(?:b|strong)\b[^>]*>(.*?)</(?:b|strong)\s*>", r"**\1**"),
            (r"(?is)<(?:i|em)\b[^>]*>(.*?)</(?:i|em)\s*>", r"_\1_"),
            (r"(?is)<code\b[^>]*>(.*?)</code\s*>", r"`\1`"),
            (r'(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a\s*>', r"[\2](\1)"),
        ],
    )
    for level in range(1, 7):
        x = rf"regexp_replace({x}, '(?i)<h{level}\b[^>]*>', E'\n\n{'#' * level} ', 'g')"
    x = rf"regexp_replace({x}, '(?i)<li\b[^>]*>', E'\n* ', 'g')"
    x = rf"regexp_replace({x}, '(?i)<br\b[^>]*>', E'\n', 'g')"
    x = rf"regexp_replace({x}, '(?i)<hr\b[^>]*>', E'\n\n***\n\n', 'g')"
    x = (
        rf"regexp_replace({x}, '(?i)</?(?:h[1-6]|p|div|section|article|main|header|aside|blockquote|ul|ol|table)\b[^>]*>', "
        r"E'\n\n', 'g')"
    )
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    x = entities(x)
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, ' ?\n ?', E'\n', 'g')"
    return strip(rf"regexp_replace({x}, '\n{{3,}}', E'\n\n', 'g')")


def entities(x: str) -> str:
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"),
        ("&middot;", "·"), ("&copy;", "©"), ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&"),
    ):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def title_of(title: str, content: str) -> str:
    return (
        f"coalesce(nullif({strip(title)}, ''), "
        + ", ".join(
            rf"nullif({strip(f'''regexp_extract({content}, '{p}', 1)''')}, '')"
            for p in (r"(?m)^#[ \t]+(\S.*)$", r"(?m)^##[ \t]+(\S.*)$", r"(?m)^###[ \t]+(\S.*)$", r"(?m)^Title:[ \t]*(\S.*)$")
        )
        + rf", {strip(f'''string_split({strip(content)}, E'{chr(92)}n')[1]''')})"
    )


def plain_of(src: str, out: str, keep: str, safe: bool = False) -> str:
    """CTEs from `src`(keep..., content) to `out`(keep..., plain)."""
    marks = [
        (r"(?s)```.*?```", ""), (r"`([^`]*)`", r"\1"), (r"!\[([^\]]*)\]\([^\)]*\)", r"\1"), (r"\[([^\]]+)\]\([^\)]+\)", r"\1"),
    ]
    lists = [
        (r"(?m)^\s{0,3}#{1,6}\s+", ""), (r"(?m)^([A-Za-z].*?)\n[-=]{3,}\s*$", r"\1"), (r"(?m)^\s*[-*+]\s+", "- "), (r"(?m)^\s*\d+\.\s+", "- "),
    ]
    emphasis = [
        (r"(?s)\*\*(.*?)\*\*", r"\1"), (r"(?s)__(.*?)__", r"\1"), (r"(?s)\*(.*?)\*", r"\1"), (r"(?s)_(.*?)_", r"\1"),
    ]
    by_word = (r"(?m)(^|[^\p{L}\p{N}_])_([^\s_](?:[^_\n]*[^\s_])?)_([^\p{L}\p{N}_]|$)", r"\1\2\3")
    within_lines = [
        (r"\*\*([^\s*](?:[^*\n]*[^\s*])?)\*\*", r"\1"), (r"__([^\s_](?:[^_\n]*[^\s_])?)__", r"\1"),
        (r"\*([^\s*](?:[^*\n]*[^\s*])?)\*", r"\1"), by_word, by_word,
    ]
    inline = chain("content", marks + lists + within_lines if safe else marks + emphasis + lists)
    colon = ":?" if safe else ""
    cells = (
        f"array_to_string(list_filter(list_transform(string_split(trim(x, '|'), '|'), lambda c: {strip('c')}), "
        "lambda c: c <> ''), ' - ')"
    )
    lines = rf"""array_to_string(list_transform(list_filter(list_transform(
      string_split_regex(a, '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{1c}}-\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: {strip('x')}),
      lambda x: NOT regexp_matches(x, '^\|?\s*{colon}-+{colon}\s*(?:\|\s*{colon}-+{colon}\s*)+\|?$')),
      lambda x: CASE WHEN contains(x, '|') THEN {cells} ELSE x END), E'\n')"""
    tail = chain(
        "b",
        [
            (r"\\([\\`*_{}\[\]()#+\-\.!\"''])".replace('\\"', '"'), r"\1"), (r"(?m)^\s*[*]{3,}\s*$", ""),
            (r"(?m)^\s*[-]{3,}\s*$", ""), (r"(?m)^\s*=_+\s*$", ""), (r"(?m)^\s*Image\s+\d+\s*$", ""),
            (r"(?m)^\s*Request Edit\s*$", ""), (r"[ \t]+", " "),
        ],
    )
    tail = strip(rf"regexp_replace({tail}, '\n{{3,}}', E'\n\n', 'g')")
    return (
        f"{out}_a AS (SELECT {keep}, {inline} AS a FROM {src}), {out}_b AS (SELECT {keep}, {lines} AS b FROM {out}_a), "
        f"{out} AS (SELECT {keep}, {tail} AS plain FROM {out}_b)"
    )


# ---- cleaning --------------------------------------------------------------------------

WIKI_HEADER = (
    r"(?m)^###\s+(.+?)\s+Request Edit\s*\r?\n+\s*Last Edited on\s*:\s*.+?Share\s*\r?\n+\s*Copy URL Facebook X\s*\r?\n*"
)
SOCIAL = r"^\s*(?:Share|Copy URL|Facebook|Instagram|Twitch|Twitter|Youtube|Discord|TikTok)"
LINK = r"^\[.*?\]\(https?:.*?\)"


def clean_wiki(content: str) -> str:
    body = rf"regexp_extract({content}, '{WIKI_HEADER}([\s\S]*)', 2)"
    for p in (
        r"^_*The content of the game guide may differ from the actual game content",
        r"^###\s*Request Edit\b", r"^Close Request to Update\b", r"^Send Request to Update\b",
        rf"(?:{SOCIAL}.*$\n?){{2,}}", rf"{LINK}.*?{LINK}.*?{LINK}", r"^\[!\[Image.*?PEGI.*?\]\(.*?\)\]",
    ):
        body = f"regexp_replace({body}, '(?ims){p}.*', '')"
    body = strip(rf"regexp_replace({body}, '\n{{3,}}', E'\n\n', 'g')")
    return (
        f"CASE WHEN regexp_matches({content}, '{WIKI_HEADER}') THEN concat('### ', regexp_extract({content}, '{WIKI_HEADER}', 1), "
        rf"E'\n\n', {body}) ELSE {strip(content)} END"
    )


def titled(titles, content: str, text: str) -> str:
    found = ", ".join(f"nullif({strip(f'''regexp_extract({content}, '{p}', 1)''')}, '')" for p in titles)
    return rf"concat('# ', coalesce({found}, 'Unknown'), E'\n\n', {strip(text)}, E'\n')"


INTROS = (
    r"(?im)^Introduction\s*[\r\n]+[-=]{3,}", r"(?im)^##\s+Introduction\s*$",
    r"(?im)^###\s+Introduction\s*$", r"(?im)^####\s+Introduction\s*$",
)


def clean_blog(content: str) -> str:
    bare = content
    for p in (r"^Title:.*?-\s*BDFoundry\s*$", r"^Description:.*$", r"^Skip to content\s*$"):
        bare = f"regexp_replace({bare}, '(?im){p}', '')"
    text = "coalesce(" + ", ".join(rf"nullif(regexp_extract({content}, '{p}[\s\S]*', 0), '')" for p in INTROS) + f", {bare})"
    text = rf"regexp_replace({text}, '(?ims)^(?:\*\*Last Updated:\*\*|You are here:).*?(^#|^Introduction|\z)', '\1', 'g')"
    text = f"string_split({text}, 'The content of the game guide may differ from the actual game content')[1]"
    text = (
        rf"regexp_replace({text}, '(?ims)^\s*(?:####\s*Quick\s+Links|\*\*Navigation\*\*\s*Hide)\s*$.+?(^\s*(?:##|\[By|Introduction|\z))', "
        r"'\1', 'g')"
    )
    text = (
        rf"regexp_replace({text}, '(?im)^\s*(?:\[By\s+[^\]]+\]\(.*?\)|###\s+Check\s+these\s+out\s+before\s+you\s+go!\s*$)[\s\S]*', '')"
    )
    titles = (r"(?m)^Title:\s*(.+?)\s*-\s*BDFoundry\s*$", r"(?m)^(.+?)\s*-\s*BDFoundry\s*$")
    return f"CASE WHEN {content} = '' THEN '' ELSE {titled(titles, content, text)} END"


def clean_tool(content: str) -> str:
    intros = (r"(?im)^1\.\s+Introduction\s*$",) + INTROS[1:]
    stripped = strip(content)
    by_line = r"(?im)^!\[.*?\]\(.*?\)\s*By\s+.*$"
    text = (
        "coalesce("
        + ", ".join(rf"nullif(regexp_extract({stripped}, '{p}[\s\S]*', 0), '')" for p in intros)
        + rf", CASE WHEN regexp_matches({stripped}, '{by_line}') THEN regexp_extract({stripped}, '{by_line}([\s\S]*)', 1) ELSE {stripped} END)"
    )
    text = rf"regexp_replace({text}, '(?im)^[^\n]*Let\s+us\s+know![\s\S]*', '')"
    title = r"(?m)^(.+?)\s*\|\s*Guide\s*\|\s*Garmoth\.com\s*-\s*BDO\s*Companion\s*$"
    return f"CASE WHEN {content} = '' THEN '' ELSE {titled((title,), content, text)} END"


def clean_default(content: str) -> str:
    x = rf"regexp_replace({content}, '\[.*?\]\(.*?\)', '', 'g')"
    return strip(rf"regexp_replace({x}, '\n+', E'\n', 'g')")


CLEAN_BY_URL = (
    f"CASE WHEN contains(url, 'garmoth.com') THEN {clean_tool('content')} "
    f"WHEN contains(url, 'playblackdesert.com') THEN {clean_wiki('content')} "
    f"WHEN contains(url, 'blackdesertfoundry.com') THEN {clean_blog('content')} ELSE {clean_default('content')} END"
)
DATE = strip(
    r"""CASE WHEN contains(url, 'playblackdesert.com') THEN regexp_extract(content, '(?i)Last Edited on\s*:\s*(.*?)\s+Share', 1)
  WHEN contains(url, 'blackdesertfoundry.com') THEN regexp_extract(content, '(?im)\*\*Last Updated:\*\*\s*(.*?)(?:\s*\||\s*$)', 1)
  WHEN contains(url, 'garmoth.com') THEN regexp_extract(content, '(?im)Updated:\s*(.*?)(?:\s*\||\s*$)', 1) ELSE '' END"""
)
CLEANED = (
    f"cleaned AS (SELECT doc_id, url, date, {title_of(chr(39) * 2, 'content')} AS guide_title, content FROM "
    f"(SELECT doc_id, url, {DATE} AS date, {CLEAN_BY_URL} AS content FROM sites WHERE content <> '') WHERE content <> '')"
)

# ---- headings --------------------------------------------------------------------------

HEADING = r"^(?:#{1,6}[ \t]+\S|[^\s#][^\n]+\n[-=]{3,}[ \t]*(?:\n|\z))"
HEADING_WIDE = r"^(?:#{1,6}[ \t]+\S|[^\n]+\n[-=]{3,}[ \t]*(?:\n|\z)|\d+\.[ \t]+\S)"
LINES = r"""{out} AS (SELECT doc_id, i, line, lead(line) OVER w AS nxt, lag(line) OVER w AS prv
  FROM (SELECT doc_id, u.line, u.i FROM {src}, unnest(string_split(content, E'\n')) WITH ORDINALITY AS u(line, i))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


def lines_cte(src: str, out: str = "lines") -> str:
    return LINES.format(src=src, out=out)


def sections_cte(flag: str, out: str = "chunks", lines: str = "lines") -> str:
    """Cut lines at `flag`, strip, drop empty ones, number them."""
    return rf"""{out} AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS piece_no, text FROM (
      SELECT doc_id, g, {strip("string_agg(line, E'" + chr(92) + "n' ORDER BY i)")} AS text FROM (
        SELECT *, sum(CASE WHEN {flag} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM {lines})
      GROUP BY doc_id, g) WHERE text <> '')"""


def preamble_cte(max_chars: int, src: str = "chunks", out: str = "merged") -> str:
    return rf"""{out} AS (SELECT doc_id, greatest(piece_no - CASE WHEN joins THEN 1 ELSE 0 END, 1) AS piece_no,
      string_agg(text, E'\n\n' ORDER BY piece_no) AS text FROM (
        SELECT *, count(*) OVER d > 1 AND NOT regexp_matches(first(text) OVER d, '{HEADING_WIDE}')
          AND length(first(text) OVER d) <= {max_chars} AS joins
        FROM {src} WINDOW d AS (PARTITION BY doc_id ORDER BY piece_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
      GROUP BY ALL)"""


H3 = r"starts_with(line, '### ') OR (regexp_matches(line, '^[A-Za-z]') AND coalesce(regexp_matches(nxt, '^-+$'), false))"
H2_H4 = (
    r"regexp_matches(line, '^#{2,4}[ \t]+\S') OR (regexp_matches(line, '^[^\s#]') AND NOT regexp_matches(line, '^-{3,}[ \t]*$') "
    r"AND coalesce(regexp_matches(nxt, '^-{3,}[ \t]*$'), false))"
)
GENERIC = (
    r"regexp_matches(line, '^#{2,6}[ \t]+\S') OR (regexp_matches(line, '^[^\s#]') AND NOT regexp_matches(line, '^-+[ \t]*$') "
    r"AND coalesce(regexp_matches(nxt, '^-+[ \t]*$'), false)) OR (regexp_matches(line, '^\d+\.[ \t]+\S') AND coalesce(rule_at <= text_at + 2, false))"
)
RULED = rf"""ruled AS (SELECT *, min(CASE WHEN {strip('line')} <> '' THEN i END) OVER a AS text_at,
  min(CASE WHEN regexp_matches(line, '^[ \t]*\*{{3,}}[ \t]*$') THEN i END) OVER a AS rule_at
  FROM lines WINDOW a AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""
GENERIC_CTES = (
    f"{GUIDES}, {lines_cte('guides')}, {RULED}, {sections_cte(GENERIC, lines='ruled')}, {preamble_cte(160)}"
)
H3_CTES = f"{GUIDES}, {lines_cte('guides')}, {sections_cte(H3)}"

RECOMBINED = rf"""measured AS (SELECT doc_id, piece_no, text, {words('text')} AS w, regexp_matches(text, '{HEADING}') AS h FROM merged),
  walk AS (SELECT doc_id, piece_no, w AS total, 1 AS g FROM measured WHERE piece_no = 1
    UNION ALL SELECT m.doc_id, m.piece_no,
      CASE WHEN m.h OR (walk.total + m.w) * 13 // 10 > 250 THEN m.w ELSE walk.total + m.w END,
      walk.g + CASE WHEN m.h OR (walk.total + m.w) * 13 // 10 > 250 THEN 1 ELSE 0 END
    FROM walk JOIN measured m ON m.doc_id = walk.doc_id AND m.piece_no = walk.piece_no + 1)"""
ORPHANS = rf"""shorts AS (SELECT doc_id, piece_no, text, {words('text')} < 15 AND regexp_matches(text, '{HEADING}') AS s FROM merged),
  islands AS (SELECT *, piece_no - row_number() OVER (PARTITION BY doc_id, s ORDER BY piece_no) AS island FROM shorts),
  placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s, island ORDER BY piece_no) - 1 AS k,
    count(*) OVER (PARTITION BY doc_id, s, island) AS n FROM islands),
  opened AS (SELECT *, CASE WHEN s THEN k % 2 = 0
    ELSE NOT coalesce(lag(s) OVER d AND lag(n) OVER d % 2 = 1, false) END AS opens
    FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY piece_no))"""


def pretokens(text: str) -> str:
    """Words with their blank and runs of white space, four characters a token, counted over the whole text."""
    return rf"coalesce(list_sum(list_transform(regexp_extract_all({text}, ' ?[^ \n]+|[ \n]+'), lambda p: (length(p) + 3) // 4)), 0)"


# Every joined text is counted anew.
EXACT = rf"""measured AS (SELECT doc_id, piece_no, text, regexp_matches(text, '{HEADING}') AS h FROM merged),
  walk AS (SELECT doc_id, piece_no, text AS joined, 1 AS g FROM measured WHERE piece_no = 1
    UNION ALL SELECT doc_id, piece_no, CASE WHEN opens THEN text ELSE both_texts END, g + CASE WHEN opens THEN 1 ELSE 0 END
    FROM (SELECT m.doc_id, m.piece_no, m.text, walk.g, concat(walk.joined, E'\n\n', m.text) AS both_texts,
        m.h OR {pretokens("concat(walk.joined, E'" + chr(92) + "n" + chr(92) + "n', m.text)")} > 250 AS opens
      FROM walk JOIN measured m ON m.doc_id = walk.doc_id AND m.piece_no = walk.piece_no + 1))"""


def blocks_flag(line: str = "line", prv: str = "prv") -> str:
    return (
        rf"regexp_matches({line}, '^\s*#{{1,6}}\s+\S') OR ({strip(line)} = '' AND coalesce({strip(prv)} <> '', false)) "
        rf"OR (regexp_matches({line}, '^\s*\*') AND NOT starts_with({line}, ' '))"
    )


OVERSIZE = rf"""heads AS (SELECT doc_id, min(i) AS at FROM lines WHERE regexp_matches(line, '^[ \t]*#{{1,6}}[ \t]')
    OR ({strip('line')} <> '' AND coalesce(regexp_matches(nxt, '^[ \t]*[-=]{{3,}}[ \t]*$'), false)) GROUP BY doc_id),
  titled AS (SELECT h.doc_id, h.at, CASE WHEN regexp_matches(l.line, '^[ \t]*#{{1,6}}[ \t]') THEN l.line ELSE concat(l.line, E'\n', l.nxt) END AS heading,
    CASE WHEN regexp_matches(l.line, '^[ \t]*#{{1,6}}[ \t]') THEN h.at + 1 ELSE h.at + 2 END AS rest_at, {strip('l.line')} AS title
    FROM heads h JOIN lines l ON l.doc_id = h.doc_id AND l.i = h.at),
  large AS (SELECT g.doc_id, coalesce(t.heading, '## Content Section') AS heading, coalesce(t.at, 0) AS at, coalesce(t.rest_at, 1) AS rest_at,
    greatest(250 - {tokens("coalesce(t.title, '## Content Section')")} - 100, 1) AS cap
    FROM guides g LEFT JOIN titled t USING (doc_id) WHERE {tokens('g.content')} > 250),
  sided AS (SELECT l.doc_id, l.i, l.line, CASE WHEN l.i < b.at THEN 0 ELSE 1 END AS side FROM lines l JOIN large b USING (doc_id)
    WHERE l.i < b.at OR l.i >= b.rest_at),
  kept AS (SELECT s.*, lag(line) OVER (PARTITION BY s.doc_id, side ORDER BY i) AS prv FROM sided s
    WHERE side = 1 OR doc_id IN (SELECT doc_id FROM sided WHERE side = 0 GROUP BY doc_id HAVING bool_or({strip('line')} <> ''))),
  cut AS (SELECT *, sum(CASE WHEN prv IS NULL OR ({blocks_flag()}) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM kept),
  blocks AS (SELECT doc_id, b, string_agg(line, E'\n' ORDER BY i) AS block FROM cut GROUP BY doc_id, b),
  weighed AS (SELECT blocks.*, large.cap, {tokens('block')} > large.cap AS split FROM blocks JOIN large USING (doc_id)),
  units AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY b, k) AS u, text, {tokens('text')} AS t, cap, split, k FROM (
    SELECT doc_id, b, block AS text, cap, split, 1 AS k FROM weighed WHERE NOT split
    UNION ALL SELECT doc_id, b, s.text, cap, split, s.k FROM weighed,
      unnest(string_split(regexp_replace(block, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1))) WITH ORDINALITY AS s(text, k) WHERE split)),
  walk AS (SELECT doc_id, u, t AS total, 1 AS g, true AS opens FROM units WHERE u = 1
    UNION ALL SELECT n.doc_id, n.u,
      CASE WHEN (n.split AND n.k = 1) OR walk.total + n.t > n.cap THEN n.t ELSE walk.total + n.t END,
      walk.g + CASE WHEN (n.split AND n.k = 1) OR walk.total + n.t > n.cap THEN 1 ELSE 0 END,
      (n.split AND n.k = 1) OR walk.total + n.t > n.cap
    FROM walk JOIN units n ON n.doc_id = walk.doc_id AND n.u = walk.u + 1),
  bodies AS (SELECT doc_id, g, count(*) OVER (PARTITION BY doc_id) AS n, body FROM (
    SELECT walk.doc_id, walk.g, string_agg(concat(CASE WHEN opens THEN '' WHEN split THEN E'\n' ELSE E'\n\n' END, text), '' ORDER BY walk.u) AS body
    FROM walk JOIN units USING (doc_id, u) GROUP BY walk.doc_id, walk.g))"""


def marked(heading: str, body: str, k: str, n: str) -> str:
    return (
        rf"CASE WHEN {k} = 1 THEN concat({heading}, E'\n\n', {body}, CASE WHEN {n} > 1 THEN E'\n\n**[Continued in Part 2]**' ELSE '' END) "
        rf"ELSE concat({heading}, E'\n\n**[Part ', {k}, ' of ', {n}, E' - Continued]**\n\n', {body}) END"
    )


def context_ctes(src: str) -> str:
    """`contexts`(doc_id, chunk_no, context) of `src`(doc_id, piece_no, text)."""
    return rf"""parts_l AS (SELECT doc_id, piece_no, i, {strip('line')} AS line FROM (
      SELECT doc_id, piece_no, v.line, v.i FROM {src}, unnest(string_split(text, E'\n')) WITH ORDINALITY AS v(line, i))),
    looked AS (SELECT *, lead(line) OVER (PARTITION BY doc_id, piece_no ORDER BY i) AS nxt FROM parts_l),
    named AS (SELECT *, CASE WHEN starts_with(line, '#') THEN length(regexp_extract(line, '^#+', 0))
        WHEN starts_with(nxt, '===') THEN 1 WHEN regexp_matches(nxt, '^-{{3,}}\s*$') THEN 2 END AS level,
      CASE WHEN starts_with(line, '#') THEN {strip("ltrim(line, '#')")} ELSE line END AS title FROM looked),
    top AS (SELECT * FROM named WHERE level IS NOT NULL AND title <> ''
      QUALIFY row_number() OVER (PARTITION BY doc_id, piece_no ORDER BY i) <= 3),
    printed AS (SELECT doc_id, piece_no, string_agg(concat(repeat('  ', level - 1), repeat('#', level), ' ', title), E'\n' ORDER BY i) AS context
      FROM top GROUP BY doc_id, piece_no),
    contexts AS (SELECT c.doc_id, c.piece_no AS chunk_no, c.text, coalesce(p.context, 'Guide Section') AS context
      FROM {src} c LEFT JOIN printed p USING (doc_id, piece_no))"""


# ---- long structures -------------------------------------------------------------------

RULE_ROW = r"regexp_matches(trim(line), '^\|[\s|:]*-[\s|:\-]*$')"
ITEM = r"regexp_matches(line, '^(?:[*+\-]|\d+\.)\s+[\p{L}\p{N}_]')"
MAIN = r"regexp_matches(line, '^\*\s+[\p{L}\p{N}_\[]')"
NESTED = r"regexp_matches(line, '^\s{2,}\*\s+')"
STAR = r"regexp_matches(line, '^\*\s+')"


def numbered(name: str, src: str) -> str:
    return rf"""{name} AS (SELECT doc_id, u.line, u.i FROM {src}, unnest(string_split(content, E'\n')) WITH ORDINALITY AS u(line, i))"""


def ahead(passing: str) -> str:
    """True if one of the next four lines is nested with only `passing` lines before it."""
    return (
        "coalesce(min(CASE WHEN nested THEN i END) OVER f, 1000000000) < "
        f"coalesce(min(CASE WHEN NOT nested AND NOT ({passing}) THEN i END) OVER f, 1000000001) "
        "AND min(CASE WHEN nested THEN i END) OVER f IS NOT NULL"
    )


PROFILE = rf"""{numbered('sl', 'src')},
  cls AS (SELECT *, {MAIN} AS main, {NESTED} AS nested, {STAR} AS star, {strip('line')} = '' AS blank, {ITEM} AS item,
    starts_with({strip('line')}, '|') AND NOT {RULE_ROW} AS tablerow FROM sl),
  looked AS (SELECT *, star AND {ahead('blank OR star')} AS has_nested,
    sum(CASE WHEN main THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g
    FROM cls WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING)),
  counts AS (SELECT doc_id, count(*) FILTER (tablerow) AS raw_rows, count(*) FILTER (item) AS list_items,
    count(DISTINCT g) FILTER (nested AND g > 0) AS nested_groups, count(*) FILTER (nested AND g > 0) AS nested_items,
    bool_or(has_nested) AS has_nested FROM looked GROUP BY doc_id),
  profiles AS (SELECT doc_id, CASE WHEN raw_rows > 1 THEN raw_rows - 1 ELSE raw_rows END AS table_rows, list_items, nested_groups, nested_items,
    nested_groups >= 5 OR nested_items >= 12 AS is_nested,
    CASE WHEN raw_rows > 1 THEN raw_rows - 1 ELSE raw_rows END >= 15 AS is_table,
    NOT has_nested AND list_items >= 25 AS is_list FROM counts),
  kinds AS (SELECT *, CASE WHEN is_nested THEN 'nested' WHEN is_table THEN 'table' WHEN is_list THEN 'list' ELSE 'plain' END AS kind FROM profiles)"""


def assembled(p: str, unit: str, per: int, name: str, body: str) -> str:
    """Parts from {p}_items(doc_id, n, item) and {p}_ctx(doc_id, heading, name, header, rest)."""
    return rf"""{p}_buckets AS (SELECT doc_id, (n - 1) // {per} + 1 AS k, min(n) AS a, max(n) AS b, any_value(total) AS total,
      string_agg(item, E'\n' ORDER BY n) AS body FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS total FROM {p}_items) GROUP BY doc_id, k),
    {p}_texts AS (SELECT doc_id, k, '{unit.lower()}' AS kind, concat(CASE WHEN heading <> '' THEN concat(heading, E'\n\n') ELSE '' END,
      E'\n**[Part ', k, ': {unit} ', a, '-', b, ' of ', total, ' total', CASE WHEN name <> '' THEN concat(' - ', name) ELSE '' END, E']**\n\n\n', {body}) AS text
      FROM {p}_buckets JOIN {p}_ctx USING (doc_id)
      UNION ALL SELECT doc_id, 1000000000, 'rest', rest FROM {p}_ctx WHERE rest <> '' AND doc_id IN (SELECT doc_id FROM {p}_items)),
    {p}_parts AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS part_no, count(*) OVER (PARTITION BY doc_id) AS n_parts, kind, text
      FROM (SELECT * FROM {p}_texts UNION ALL SELECT doc_id, 1, 'plain', content FROM {name} WHERE doc_id NOT IN (SELECT doc_id FROM {p}_items)))"""


def agg(filter_: str) -> str:
    return strip(rf"coalesce(string_agg(line, E'\n' ORDER BY i) FILTER ({filter_}), '')")


def name_of(last: str, any_text: bool) -> str:
    bold = f"starts_with({last}, '**') AND ends_with({last}, '**')"
    hashes = strip(f"ltrim({last}, '#')")
    stars = strip(f"trim({last}, '*')")
    return f"CASE WHEN starts_with({last}, '#') THEN {hashes} WHEN {bold} THEN {stars} ELSE {last if any_text else chr(39) * 2} END"


def table_ctes(src: str) -> str:
    return rf"""{numbered('tl', src)},
  t_at AS (SELECT doc_id, min(i) AS s FROM tl WHERE starts_with({strip('line')}, '|') GROUP BY doc_id),
  t_end AS (SELECT tl.doc_id, min(i) AS e FROM tl JOIN t_at USING (doc_id) WHERE i > s AND NOT starts_with({strip('line')}, '|') GROUP BY tl.doc_id),
  t_all AS (SELECT tl.doc_id, i, line, s, coalesce(e, 1000000000) AS e, {RULE_ROW} AS rule FROM tl JOIN t_at USING (doc_id) LEFT JOIN t_end USING (doc_id)),
  t_rows AS (SELECT doc_id, {strip('line')} AS item, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS n FROM t_all WHERE i >= s AND i < e AND NOT rule),
  t_items AS (SELECT * FROM t_rows WHERE n > 0),
  t_last AS (SELECT doc_id, {strip('line')} AS last FROM t_all WHERE i = s - 1),
  t_base AS (SELECT doc_id, {agg('i < s')} AS heading, {agg('i >= e')} AS rest,
    arg_max({strip('line')}, i) FILTER (i >= s AND i < e AND rule) AS rule FROM t_all GROUP BY doc_id),
  t_ctx AS (SELECT doc_id, heading, rest, {name_of("coalesce(last, '')", True)} AS name,
    concat(h.item, E'\n', CASE WHEN rule IS NULL THEN '' ELSE concat(rule, E'\n') END) AS header
    FROM t_base JOIN t_rows h USING (doc_id) LEFT JOIN t_last USING (doc_id) WHERE h.n = 0),
  {assembled('t', 'Rows', 8, src, 'concat(header, body)')}"""


def list_ctes(src: str) -> str:
    return rf"""{numbered('ll', src)},
  l_g AS (SELECT *, sum(CASE WHEN {ITEM} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM ll),
  l_items AS (SELECT doc_id, g AS n, string_agg(line, E'\n' ORDER BY i) AS item FROM l_g WHERE g > 0 GROUP BY doc_id, g),
  l_ctx AS (SELECT doc_id, {agg('g = 0')} AS heading, '' AS name, '' AS rest FROM l_g GROUP BY doc_id),
  {assembled('l', 'Items', 12, src, 'body')}"""


def nested_ctes(src: str) -> str:
    return rf"""{numbered('nl', src)},
  n_cls AS (SELECT *, {MAIN} AS main, {NESTED} AS nested, regexp_matches(line, '^\s+\*\s+') AS sub, {STAR} AS star,
    {strip('line')} = '' AS blank, regexp_matches(line, '^\s') AS indented FROM nl),
  n_look AS (SELECT *, main AND {ahead('blank OR star OR indented')} AS starts
    FROM n_cls WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING)),
  n_at AS (SELECT doc_id, min(i) AS s FROM n_look WHERE starts GROUP BY doc_id),
  n_end AS (SELECT doc_id, min(i) AS e FROM n_look JOIN n_at USING (doc_id) WHERE i > s AND NOT (main OR sub OR blank) GROUP BY doc_id),
  n_all AS (SELECT n_look.*, s, coalesce(e, 1000000000) AS e FROM n_look JOIN n_at USING (doc_id) LEFT JOIN n_end USING (doc_id)),
  n_g AS (SELECT *, sum(CASE WHEN main THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM n_all WHERE i >= s AND i < e),
  n_items AS (SELECT doc_id, g AS n, string_agg(line, E'\n' ORDER BY i) AS item FROM n_g GROUP BY doc_id, g),
  n_last AS (SELECT doc_id, {strip('line')} AS last FROM n_all WHERE i = s - 1),
  n_base AS (SELECT doc_id, {agg('i < s')} AS heading, {agg('i >= e')} AS rest FROM n_all GROUP BY doc_id),
  n_ctx AS (SELECT doc_id, heading, rest, {name_of("coalesce(last, '')", False)} AS name FROM n_base LEFT JOIN n_last USING (doc_id)),
  {assembled('n', 'Groups', 8, src, 'body')}"""


PART_COLUMNS = "doc_id, n_parts, part_no, kind, text"

# ---- answers ---------------------------------------------------------------------------

ANSWER = strip(rf"regexp_replace(regexp_replace({strip('raw')}, '\A```(?:json)?\s*', ''), '\s*```\z', '')")


def repaired(x: str) -> str:
    x = rf"""regexp_replace({x}, '\\([^"\\/bfnrtu]|\z)', '\1', 'g')"""
    x = rf"regexp_replace({x}, '\\u([0-9a-fA-F]{{4}})', concat(chr(1), '\1'), 'g')"
    x = rf"regexp_replace({x}, '\\u', 'u', 'g')"
    return rf"replace({x}, chr(1), '\u')"


PARSED = rf"""answers AS (SELECT request_id, attempt, {ANSWER} AS answer FROM responses),
  readable AS (SELECT *, CASE WHEN json_valid(answer) THEN answer ELSE {repaired('answer')} END AS j FROM answers),
  listed AS (SELECT request_id, attempt, answer, CASE
      WHEN json_valid(j) AND json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]')::VARCHAR[]
      WHEN json_valid(j) AND json_type(j) = 'OBJECT' THEN [j]
      WHEN json_valid(j) THEN []::VARCHAR[]
      ELSE list_filter(list_transform(string_split(j, E'\n'), lambda x: {strip('x')}), lambda x: starts_with(x, '{{') AND ends_with(x, '}}') AND json_valid(x)) END AS items
    FROM readable),
  valid AS (SELECT request_id, attempt, answer, list_filter(items, lambda x: json_type(x) = 'OBJECT'
      AND coalesce(json_type(x, '$.conversations'), '') = 'ARRAY' AND json_array_length(x, '$.conversations') >= 2
      AND len(list_filter(json_extract(x, '$.conversations[*]'), lambda c: json_type(c) = 'OBJECT'
        AND list_contains(json_keys(c), 'role') AND list_contains(json_keys(c), 'content'))) = json_array_length(x, '$.conversations')) AS items FROM listed),
  found AS (SELECT request_id, attempt, v.k - 1 AS seq, v.item FROM valid, unnest(items) WITH ORDINALITY AS v(item, k))"""
ALL_PARSED = f"{RESPONSES}, {PARSED}"
TURN_ROWS = """turn_rows AS (SELECT request_id, attempt, seq, t.k - 1 AS turn_no, json_extract_string(t.turn, '$.role') AS role,
  json_extract_string(t.turn, '$.content') AS content FROM found, unnest(json_extract(item, '$.conversations[*]')) WITH ORDINALITY AS t(turn, k))"""
PAIRS = """pairs AS (SELECT request_id, seq, turn_no, content AS question, answer FROM (SELECT *, lead(role) OVER w AS next_role, lead(content) OVER w AS answer
  FROM turn_rows WINDOW w AS (PARTITION BY request_id, attempt, seq ORDER BY turn_no)) WHERE role = 'user' AND next_role = 'assistant')"""
COUNTED = """counted AS (SELECT f.request_id, count(p.turn_no) AS pairs FROM (SELECT DISTINCT request_id FROM found) f
  LEFT JOIN pairs p USING (request_id) GROUP BY f.request_id)"""
SPOKEN = f"""spoken AS (SELECT request_id, seq, sum(CASE WHEN role = 'assistant' THEN {tokens('content')} ELSE 0 END)::BIGINT AS answer_tokens
  FROM turn_rows GROUP BY request_id, seq)"""
UNIQUE_LINKS = r"""found_links AS (SELECT file, u.url, u.k - 1 AS pos FROM link_files,
    unnest(regexp_extract_all(regexp_replace(text, '!\[', '!(', 'g'), '\[[^\]]*\]\((https?://[^\s)]+)(?:\s+"[^"]*")?\)', 1)) WITH ORDINALITY AS u(url, k)),
  unique_links AS (SELECT url, file, pos FROM found_links QUALIFY row_number() OVER (PARTITION BY url ORDER BY file, pos) = 1)"""
PROCESSED = f"processed AS (SELECT DISTINCT {strip('value')} AS url FROM state WHERE {strip('value')} <> '')"
LINKS = f"WITH {LINK_FILES}, {UNIQUE_LINKS}, {STATE}, {PROCESSED}"


def pieces(ctes: str, src: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes} SELECT doc_id, piece_no, text FROM {src}"


def renamed(sql: str, names: dict[str, str]) -> str:
    """The same CTEs under other names, so that one query can hold them twice."""
    for old, new in names.items():
        sql = re.sub(rf"\b{old}\b", new, sql)
    return sql


# From site pages to prompts: each step keyed by one number, documents by doc_id * 1000000 and
# their chunks by what is added to it.
_SITE = "contains(url, 'playblackdesert.com')", "contains(url, 'blackdesertfoundry.com')", "contains(url, 'garmoth.com')"
SITE_CHUNKS = f"""{SITES}, {CLEANED},
  wiki_d AS (SELECT * FROM cleaned WHERE {_SITE[0]}), blog_d AS (SELECT * FROM cleaned WHERE {_SITE[1]}),
  tool_d AS (SELECT * FROM cleaned WHERE {_SITE[2]}),
  {lines_cte('wiki_d', 'wiki_l')}, {sections_cte(H3, 'wiki_c', 'wiki_l')},
  {lines_cte('blog_d', 'blog_l')}, {sections_cte(H2_H4, 'blog_c', 'blog_l')}, {preamble_cte(119, 'blog_c', 'blog_m')},
  {lines_cte('tool_d', 'lines')}, {RULED}, {sections_cte(GENERIC, 'tool_c', 'ruled')}, {preamble_cte(160, 'tool_c', 'tool_m')},
  merged AS (SELECT doc_id, piece_no, text FROM wiki_c UNION ALL SELECT doc_id, piece_no, text FROM blog_m
    UNION ALL SELECT doc_id, piece_no, text FROM tool_m),
  {renamed(RECOMBINED, {'walk': 'walk_r'})},
  joined AS (SELECT walk_r.doc_id, walk_r.g::BIGINT AS piece_no, string_agg(text, E'\\n\\n' ORDER BY piece_no) AS text
    FROM walk_r JOIN measured USING (doc_id, piece_no) GROUP BY walk_r.doc_id, walk_r.g),
  {renamed(ORPHANS, {'merged': 'joined'})},
  orphaned AS (SELECT doc_id, g, string_agg(text, E'\\n\\n' ORDER BY piece_no) AS content FROM (
    SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY piece_no) AS g FROM opened) GROUP BY doc_id, g),
  wholes AS (SELECT doc_id * 1000000 + g::BIGINT AS doc_id, content FROM orphaned),
  {lines_cte('wholes', 'whole_l')}, {renamed(OVERSIZE, {'lines': 'whole_l', 'guides': 'wholes'})},
  sized AS (SELECT doc_id, g, {marked('heading', 'body', 'g', 'n')} AS text FROM bodies JOIN large USING (doc_id)
    UNION ALL SELECT doc_id, 1, content FROM wholes WHERE doc_id NOT IN (SELECT doc_id FROM large)),
  numbered AS (SELECT doc_id // 1000000 AS doc_id, row_number() OVER (PARTITION BY doc_id // 1000000 ORDER BY doc_id, g) AS chunk_no, text FROM sized
    UNION ALL SELECT doc_id, 1, content FROM cleaned WHERE NOT ({' OR '.join(_SITE)})),
  src AS (SELECT doc_id * 1000000 + chunk_no AS doc_id, text AS content FROM numbered)"""
DISPATCHED = f"""src_t AS (SELECT src.* FROM src JOIN kinds USING (doc_id) WHERE kind = 'table'),
  src_l AS (SELECT src.* FROM src JOIN kinds USING (doc_id) WHERE kind = 'list'),
  src_n AS (SELECT src.* FROM src JOIN kinds USING (doc_id) WHERE kind = 'nested'),
  {table_ctes('src_t')}, {list_ctes('src_l')}, {nested_ctes('src_n')},
  parts AS (SELECT {PART_COLUMNS} FROM t_parts UNION ALL SELECT {PART_COLUMNS} FROM l_parts UNION ALL SELECT {PART_COLUMNS} FROM n_parts
    UNION ALL SELECT doc_id, 1, 1, 'plain', content FROM src JOIN kinds USING (doc_id) WHERE kind = 'plain')"""
SITE_PROMPTS = rf"""WITH RECURSIVE {SITE_CHUNKS}, {PROFILE}, {DISPATCHED},
  keyed AS (SELECT doc_id, part_no AS piece_no, text FROM parts), {renamed(context_ctes('keyed'), {'looked': 'looked_c'})}
  SELECT sha256(concat_ws(chr(31), url, chunk_no, part_no, prompt)) AS request_id, * EXCLUDE (url) FROM (
    SELECT c.url, c.doc_id, c.date, c.guide_title, p.doc_id % 1000000 AS chunk_no, p.part_no, p.n_parts, p.kind,
      concat(E'Write questions and answers about the guide below.\nUse only what it says.\n\n', 'Guide Title: ', c.guide_title,
        E'\n\nSection Hierarchy:\n', x.context, E'\n\nSource:\n', p.text) AS prompt
    FROM parts p JOIN contexts x ON x.doc_id = p.doc_id AND x.chunk_no = p.part_no JOIN cleaned c ON c.doc_id = p.doc_id // 1000000)"""
# The same way from crawled pages: their markdown, and their own titles where they have one.
PAGE_SITES = f"""sites AS (SELECT page_id AS doc_id, url, {markdown_of('html')} AS content FROM pages),
  titles AS (SELECT page_id AS doc_id, {strip(entities("regexp_extract(html, '(?is)<title" + chr(92) + "b[^>]*>(.*?)</title" + chr(92) + "s*>', 1)"))} AS title FROM pages)"""
PAGE_PROMPTS = SITE_PROMPTS.replace(SITES, PAGE_SITES).replace(
    CLEANED, CLEANED.replace("cleaned AS", "untitled AS") + """,
  cleaned AS (SELECT u.* REPLACE (coalesce(nullif(t.title, ''), u.guide_title) AS guide_title) FROM untitled u JOIN titles t USING (doc_id))"""
)


ORACLES: dict[str, str] = {
    "html_to_markdown": f"""SELECT page_id, url, {strip(entities("regexp_extract(html, '(?is)<title" + chr(92) + "b[^>]*>(.*?)</title" + chr(92) + "s*>', 1)"))} AS title,
      {markdown_of('html')} AS content FROM pages""",
    # What the writer of the HTML meant, not a copy of the conversion.
    "html_forms": rf"""SELECT doc_id, concat(repeat('#', (2 + doc_id % 5)::INT), ' Doc ', doc_id, E'\n\n',
      array_to_string(list_transform({SENTENCES}, lambda s, k: concat(k, '. ', s)), E'\n'), E'\n\n',
      array_to_string(list_transform(string_split(text, E'\n'), lambda line: concat('* Line', array_to_string(list_transform(
        list_filter(string_split(line, '. '), lambda s: trim(s) <> ''), lambda s: concat(E'\n  * ', trim(s))), ''))), E'\n'),
      E'\n\n[A é', chr(39), '€ link](https://x.example/', doc_id, E')\n\n***') AS content FROM documents""",
    "html_depths": rf"""WITH d AS (SELECT doc_id, (doc_id % 8 + 1)::INT AS n, text FROM documents)
      SELECT doc_id, concat('Doc ', doc_id, E'\n\n',
        array_to_string(list_transform(range(1, n + 1), lambda k: concat(repeat('  ', k - 1), CASE WHEN k % 2 = 0 THEN '1. ' ELSE '* ' END, 'Level ', k)), E'\n'),
        array_to_string(list_transform({SENTENCES}, lambda s, k: concat(E'\n', repeat('  ', n), k, '. ', s)), ''), E'\n',
        array_to_string(list_transform(list_reverse(range(1, n + 1)), lambda k: concat(repeat('  ', k - 1), CASE WHEN k % 2 = 0 THEN '2. ' ELSE '* ' END, 'After ', k)), E'\n'),
        E'\n\nEnd\n\n| ', doc_id, ' | in most |') AS content FROM d""",
    "unwrap_response": """SELECT page_id, CASE WHEN page_id % 4 IN (1, 2) THEN concat('T', page_id) ELSE '' END AS title,
      CASE WHEN page_id % 4 IN (1, 2) THEN concat(url, '?r') ELSE url END AS url, html AS content FROM pages""",
    "docs_nonempty": "SELECT doc_id, text AS content FROM documents WHERE doc_id % 9 > 1 AND text <> ''",
    "guide_title": f"""WITH {GUIDES} SELECT doc_id, {title_of("CASE WHEN doc_id % 4 = 0 THEN concat(' Fetched ', doc_id) ELSE '' END", 'content')} AS guide_title FROM guides""",
    "plain_text": f"""WITH {GUIDES}, {md('structs', STRUCTURES_MD)}, forms AS (SELECT 'guide' AS form, doc_id, content FROM guides
      UNION ALL SELECT 'structure', doc_id, content FROM structs), {plain_of('forms', 'plains', 'form, doc_id')} SELECT form, doc_id, plain FROM plains""",
    "cpt_blocks": rf"""WITH {SITES}, {CLEANED}, {plain_of('cleaned', 'plains', 'doc_id, url, date, guide_title')}
      SELECT doc_id, url, date, guide_title, concat('Guide Title: ', coalesce(nullif(guide_title, ''), 'Unknown'), E'\nSource URL: ', url,
        CASE WHEN date <> '' THEN concat(E'\nGuide Date: ', date) ELSE '' END, E'\n\n', plain, E'\n\n', repeat('=', 80), E'\n\n\n\n') AS block
      FROM plains WHERE plain <> ''""",
    "token_counts": f"SELECT doc_id, {words('text')} AS words, {tokens('text')} AS tokens FROM documents",
    "token_counts_plugged": "SELECT doc_id, strlen(text) // 4 AS tokens FROM documents",
    "route_domain": """SELECT page_id, url, CASE WHEN contains(url, 'example.org') THEN 'keep' WHEN contains(url, 'example.com') THEN 'strict'
      WHEN contains(url, 'blog.') THEN 'blog' ELSE 'default' END AS clean_strategy,
      CASE WHEN contains(url, 'blog.') THEN 'reader' WHEN contains(url, 'example.com') THEN 'converter'
      WHEN contains(url, 'example.net') THEN 'text' ELSE 'default' END AS fetch_strategy FROM pages""",
    "route_rules": r"""WITH rules AS (SELECT 'clean' AS stage, page_id % 7 AS priority, regexp_extract(url, '^https?://([^/]+)', 1) AS domain,
        concat('host ', page_id % 5) AS strategy FROM pages UNION ALL SELECT 'fetch', page_id % 11, right(url, 4), concat('end ', page_id % 3) FROM pages),
      best AS (SELECT p.page_id, p.url, r.stage, r.strategy FROM pages p JOIN rules r ON contains(p.url, r.domain)
        QUALIFY row_number() OVER (PARTITION BY p.page_id, p.url, r.stage ORDER BY r.priority, r.domain, r.strategy) = 1)
      SELECT p.page_id, p.url, coalesce(c.strategy, 'default') AS clean_strategy, coalesce(f.strategy, 'default') AS fetch_strategy FROM pages p
        LEFT JOIN best c ON c.page_id = p.page_id AND c.url = p.url AND c.stage = 'clean'
        LEFT JOIN best f ON f.page_id = p.page_id AND f.url = p.url AND f.stage = 'fetch'""",
    "site_routes": f"""WITH s AS (SELECT doc_id, concat({URL}, '?ref=', CASE doc_id % 3 WHEN 0 THEN 'garmoth.com' WHEN 1 THEN 'blackdesertfoundry.com' ELSE 'none' END) AS url FROM documents),
      r AS (SELECT *, contains(url, 'playblackdesert.com') AS wiki, contains(url, 'blackdesertfoundry.com') AS blog, contains(url, 'garmoth.com') AS tool FROM s)
      SELECT doc_id, url, CASE WHEN blog THEN 'blackdesertfoundry.com' WHEN tool THEN 'garmoth.com' WHEN wiki THEN 'playblackdesert.com' ELSE 'default' END AS fetch_route,
        CASE WHEN wiki THEN 'playblackdesert.com' WHEN blog THEN 'blackdesertfoundry.com' WHEN tool THEN 'garmoth.com' ELSE 'default' END AS date_route,
        CASE WHEN tool THEN 'garmoth.com' WHEN wiki THEN 'playblackdesert.com' WHEN blog THEN 'blackdesertfoundry.com' ELSE 'default' END AS clean_route,
        CASE WHEN wiki THEN 'playblackdesert.com' WHEN blog THEN 'blackdesertfoundry.com' WHEN tool THEN 'garmoth.com' ELSE 'default' END AS chunk_route FROM r""",
    "extract_date": f"WITH {SITES} SELECT doc_id, {DATE} AS date FROM sites",
    "clean_default": f"WITH {SITES} SELECT doc_id, {clean_default('content')} AS cleaned FROM sites",
    "clean_header_footer": f"WITH {SITES} SELECT doc_id, {clean_wiki('content')} AS cleaned FROM sites",
    "clean_intro_anchor": f"WITH {SITES} SELECT doc_id, {clean_blog('content')} AS cleaned FROM sites",
    "clean_title_suffix": f"WITH {SITES} SELECT doc_id, {clean_tool('content')} AS cleaned FROM sites",
    "clean_registry": f"WITH {SITES} SELECT doc_id, {CLEAN_BY_URL} AS cleaned FROM sites",
    "heading_split_h3": pieces(H3_CTES, "chunks"),
    "heading_split_h2_h4": pieces(f"{GUIDES}, {lines_cte('guides')}, {sections_cte(H2_H4)}, {preamble_cte(119)}", "merged"),
    "heading_split_generic": pieces(GENERIC_CTES, "merged"),
    "preamble_merge": pieces(f"{H3_CTES}, {preamble_cte(160)}", "merged"),
    "main_heading": rf"""WITH {H3_CTES}, l AS (SELECT doc_id, piece_no, v.line, v.i FROM chunks, unnest(string_split(text, E'\n')) WITH ORDINALITY AS v(line, i)),
      n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id, piece_no ORDER BY i) AS nxt FROM l),
      h AS (SELECT doc_id, piece_no, CASE WHEN regexp_matches(line, '^[ \t]*#{{1,6}}[ \t]') THEN line ELSE concat(line, E'\n', nxt) END AS heading FROM n
        WHERE regexp_matches(line, '^[ \t]*#{{1,6}}[ \t]') OR ({strip('line')} <> '' AND coalesce(regexp_matches(nxt, '^[ \t]*[-=]{{3,}}[ \t]*$'), false))
        QUALIFY row_number() OVER (PARTITION BY doc_id, piece_no ORDER BY i) = 1)
      SELECT c.doc_id, c.piece_no AS chunk_no, coalesce(h.heading, '## Content Section') AS heading FROM chunks c LEFT JOIN h USING (doc_id, piece_no)""",
    "heading_context": f"WITH {H3_CTES}, {context_ctes('chunks')} SELECT doc_id, chunk_no, context FROM contexts",
    "sections_recombine": rf"""WITH RECURSIVE {GENERIC_CTES}, {RECOMBINED}
      SELECT walk.doc_id, walk.g::BIGINT AS piece_no, string_agg(text, E'\n\n' ORDER BY piece_no) AS text FROM walk JOIN measured USING (doc_id, piece_no) GROUP BY walk.doc_id, walk.g""",
    "exact_recombine": rf"""WITH RECURSIVE {GENERIC_CTES}, {EXACT}, sections AS (SELECT doc_id, g, max_by(joined, piece_no) AS text FROM walk GROUP BY doc_id, g)
      SELECT doc_id, g::BIGINT AS piece_no, text, {pretokens('text')}::BIGINT AS tokens FROM sections""",
    "orphan_merge": rf"""WITH {GENERIC_CTES}, {ORPHANS}, g AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY piece_no) AS g FROM opened)
      SELECT doc_id, g::BIGINT AS piece_no, string_agg(text, E'\n\n' ORDER BY piece_no) AS text FROM g GROUP BY doc_id, g""",
    "blocks": rf"""WITH {GUIDES}, {lines_cte('guides')}, g AS (SELECT *, sum(CASE WHEN i = 1 OR ({blocks_flag()}) THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY i) AS g FROM lines) SELECT doc_id, g::BIGINT AS piece_no, string_agg(line, E'\n' ORDER BY i) AS text FROM g GROUP BY doc_id, g""",
    "sentences": r"""SELECT doc_id, s.k AS piece_no, s.text FROM documents,
      unnest(string_split(regexp_replace(documents.text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1))) WITH ORDINALITY AS s(text, k)""",
    "part_markers": f"""WITH {H3_CTES}, n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM chunks)
      SELECT doc_id, piece_no, {marked("concat('## Guide ', doc_id)", 'text', 'piece_no', 'n')} AS text FROM n""",
    "oversize_split": f"""WITH RECURSIVE {GUIDES}, {lines_cte('guides')}, {OVERSIZE}
      SELECT doc_id, g::BIGINT AS piece_no, {marked('heading', 'body', 'g', 'n')} AS text FROM bodies JOIN large USING (doc_id)
      UNION ALL SELECT doc_id, 1, content FROM guides WHERE doc_id NOT IN (SELECT doc_id FROM large)""",
    "detect_structures": f"WITH {md('src', STRUCTURES_MD)}, {PROFILE} SELECT * FROM kinds",
    "split_table": f"WITH {md('src', TABLE_MD)}, {table_ctes('src')} SELECT {PART_COLUMNS} FROM t_parts",
    "split_list": f"WITH {md('src', LIST_MD)}, {list_ctes('src')} SELECT {PART_COLUMNS} FROM l_parts",
    "split_nested": f"WITH {md('src', NESTED_MD)}, {nested_ctes('src')} SELECT {PART_COLUMNS} FROM n_parts",
    "structure_dispatch": f"WITH {md('src', STRUCTURES_MD)}, {PROFILE}, {DISPATCHED} SELECT {PART_COLUMNS} FROM parts",
    "prompts": rf"""WITH {H3_CTES}, {context_ctes('chunks')}, c AS (SELECT *, concat('Guide Title: Guide ', doc_id, E'\n\nSection Hierarchy:\n', context) AS ctx FROM contexts)
      SELECT sha256(concat_ws(chr(31), {URL}, chunk_no, 1, prompt)) AS request_id, doc_id, chunk_no, prompt
      FROM (SELECT *, concat(E'About:\n', ctx, E'\n\nAgain: ', ctx, E'\nSource:\n', text) AS prompt FROM c)""",
    "site_prompts": SITE_PROMPTS,
    "page_prompts": PAGE_PROMPTS,
    "one_capture": "SELECT url, max(page_id) + 1000000 AS page_id FROM pages GROUP BY url",
    "conversation_pairs": """SELECT conv_id, turn, text AS question, answer FROM (SELECT *, lead(turn) OVER w AS next_turn, lead(role) OVER w AS next_role,
      lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
      WHERE role = 'user' AND next_role = 'assistant' AND next_turn = turn + 1""",
    "links_unique": f"{LINKS} SELECT url, file, pos FROM unique_links",
    "processed_links": f"WITH {STATE}, {PROCESSED} SELECT url FROM processed",
    "links_pending": f"{LINKS} SELECT url, file, pos FROM unique_links WHERE url NOT IN (SELECT url FROM processed)",
    "links_done": f"{LINKS} SELECT url, file, pos FROM unique_links WHERE url IN (SELECT url FROM processed)",
    "run_summary": f"""{LINKS} SELECT count(*) AS total_links, count(*) FILTER (url NOT IN (SELECT url FROM processed)) AS new_links,
      count(*) FILTER (url IN (SELECT url FROM processed)) AS known_links FROM unique_links""",
    "incremental_links": "SELECT DISTINCT url FROM pages",
    # What passes by the rules of the stream: all first rows, the other URLs, and what comes again after the horizon.
    "recent_links": """WITH p AS (SELECT DISTINCT url, epoch(TIMESTAMP '2024-01-01')::BIGINT + 60 * (length(url) % 60) AS s FROM pages WHERE url IS NOT NULL)
      SELECT url, s AS ingest_second FROM p UNION ALL SELECT concat(url, '#other'), s + 3 * 86400 FROM p
      UNION ALL SELECT url, s + 3 * 86400 + 3600 FROM p WHERE length(url) % 3 = 0""",
    "streamed_prompts": PAGE_PROMPTS,
    "response_text": f"WITH {RESPONSES} SELECT request_id, {ANSWER} AS answer FROM responses",
    "sanitize_escapes": f"WITH {RESPONSES} SELECT request_id, {repaired('raw')} AS repaired FROM responses",
    "parse_dialogues": f"""WITH {ALL_PARSED}, {TURN_ROWS} SELECT request_id, attempt, seq, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn_no) AS roles,
      string_agg(content, '|' ORDER BY turn_no) AS contents FROM turn_rows GROUP BY request_id, attempt, seq""",
    "dialogues_valid": f"WITH {ALL_PARSED} SELECT request_id, len(items) AS valid_dialogues FROM valid",
    "invalid_responses": f"""WITH {ALL_PARSED}, {REQUESTS} SELECT request_id, attempt, substring(answer, 1, 2000) AS response_head, length(answer) AS total_len, url, prompt
      FROM valid JOIN requests USING (request_id) WHERE len(items) = 0""",
    "retry_rounds": f"""WITH {ALL_PARSED}, both_tries AS (SELECT request_id, attempt, raw, request_id IN (SELECT request_id FROM valid WHERE len(items) > 0) AS ok FROM responses
      UNION ALL SELECT request_id, 2, concat('[', dialogue, ']'), n_turns >= 2 FROM responses)
      SELECT request_id, attempt, raw FROM both_tries WHERE ok QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY attempt) = 1""",
    "jsonl_records": f"""WITH {ALL_PARSED}, {TURN_ROWS}, {SPOKEN}, {REQUESTS} SELECT f.request_id, f.seq, url, 'en' AS lang, nullif(date, '') AS date,
      answer_tokens::VARCHAR AS answer_tokens, json_extract_string(item, '$.topic') AS topic, n_turns, said
      FROM found f JOIN (SELECT request_id, seq, count(*) AS n_turns, string_agg(concat(role, ':', content), chr(31) ORDER BY turn_no) AS said
        FROM turn_rows GROUP BY ALL) USING (request_id, seq) JOIN spoken USING (request_id, seq) JOIN requests USING (request_id)""",
    "records_per_url": f"WITH {ALL_PARSED}, {REQUESTS} SELECT url, count(*) AS records FROM found JOIN requests USING (request_id) GROUP BY ROLLUP (url)",
    "processed_after_run": f"WITH {ALL_PARSED}, {REQUESTS} SELECT DISTINCT url FROM found JOIN requests USING (request_id)",
    "answer_tokens": f"WITH {ALL_PARSED}, {TURN_ROWS}, {SPOKEN} SELECT request_id, seq, answer_tokens FROM spoken",
    "quality_gate": f"""WITH {ALL_PARSED}, {TURN_ROWS}, {PAIRS} SELECT request_id, seq, turn_no, {words('question')} AS question_words, {words('answer')} AS answer_words,
      {words('question')} BETWEEN 6 AND 48 AND {words('answer')} BETWEEN 14 AND 200 AS passes FROM pairs""",
    "pairs_per_chunk": f"""WITH {ALL_PARSED}, {TURN_ROWS}, {PAIRS}, {COUNTED} SELECT request_id, pairs, pairs BETWEEN 2 AND 4 AS "within" FROM counted""",
    "meta_question_filter": rf"""WITH {ALL_PARSED}, {TURN_ROWS}, {PAIRS}, asked AS (SELECT request_id, seq, turn_no,
        CASE WHEN turn_no % 4 = 0 THEN concat('What does the Section say? ', question) ELSE question END AS question FROM pairs)
      SELECT * FROM asked WHERE NOT regexp_matches(lower(question), '\b(?:text|passage|paragraph|document|section|article|prompt|sentence|source)\b')""",
    "short_chunks": f"""WITH {ALL_PARSED}, {TURN_ROWS}, {PAIRS}, {COUNTED}, {REQUESTS} SELECT request_id, url, coalesce(pairs, 0) AS pairs
      FROM requests LEFT JOIN counted USING (request_id) WHERE coalesce(pairs, 0) < 2""",
    "generate_with_callable": f"""WITH {REQUESTS} SELECT request_id, 1::BIGINT AS attempt, concat('[{{"conversations":[{{"role":"user","content":"', prompt,
      '"}},{{"role":"assistant","content":"Yes."}}]}}]') AS raw FROM requests""",
    "records_in_order": rf"""WITH {REQUESTS}, turns AS (SELECT concat('r', doc_id) AS request_id, doc_id, s.k AS k, s.s AS s,
        CASE WHEN s.k % 2 = 1 THEN 'user' ELSE 'assistant' END AS role FROM documents, unnest({SENTENCES}) WITH ORDINALITY AS s(s, k)),
      said AS (SELECT request_id, doc_id, string_agg(concat('{{"content": "', replace(replace(replace(s, '\', '\\'), '"', '\"'), E'\t', '\t'),
          '", "role": "', role, '"}}'), ', ' ORDER BY k) AS turns,
          sum(CASE WHEN role = 'assistant' THEN {tokens('s')} ELSE 0 END)::BIGINT AS answer_tokens, count(*) AS n FROM turns GROUP BY ALL)
      SELECT request_id, concat('{{"z": {{"b": ', doc_id, ', "a": [true, null, {{"y": NaN, "x": 1.5}}]}}, "topic": {{"k": -', doc_id, '.0}}, "url": "', url,
        '", "conversations": [', turns, '], "b": "é", "a": [], "lang": "en"', CASE WHEN date <> '' THEN concat(', "date": "', date, '"') ELSE '' END,
        ', "answer_tokens": ', answer_tokens, '}}') AS record FROM said JOIN requests USING (request_id) WHERE n >= 2""",
    "ordered_records": f"""WITH {ALL_PARSED}, {TURN_ROWS}, {SPOKEN}, {REQUESTS} SELECT row_number() OVER (ORDER BY url, request_id, f.seq) AS line_no,
      url, json_extract_string(item, '$.topic') AS topic, answer_tokens::VARCHAR AS answer_tokens
      FROM found f JOIN spoken USING (request_id, seq) JOIN requests USING (request_id)""",
}
ORACLES["ordered_corpus"] = rf"""WITH blocks AS ({ORACLES["cpt_blocks"]})
  SELECT row_number() OVER (ORDER BY doc_id, v.i) AS line_no, v.line AS value
  FROM blocks, unnest(string_split(left(block, length(block) - 1), E'\n')) WITH ORDINALITY AS v(line, i)"""
ORACLES["oversize_by_rows"] = ORACLES["oversize_split"]
ORACLES["plain_text_safe"] = f"""WITH {GUIDES}, {md('structs', STRUCTURES_MD)}, forms AS (SELECT 'guide' AS form, doc_id, content FROM guides
  UNION ALL SELECT 'structure', doc_id, content FROM structs), {plain_of('forms', 'plains', 'form, doc_id', safe=True)} SELECT form, doc_id, plain FROM plains"""
