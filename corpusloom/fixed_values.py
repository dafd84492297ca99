"""Texts, patterns and formats that results depend on.

Nothing here is computed; operators import these names. Patterns are in Java
regex syntax. `(?d)` makes only a newline end a line, `[^\\S\\n]` is "blank, same line".
"""

# Characters removed by strip (Unicode white space and the ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# One word, that is a run of anything but white space (same set as above).
# The nested classes make the regex engine decide ASCII with its first test.
WORD_CHAR = (
    r"[!-~[\x{a1}-\x{167f}[\x00-\x08\x0e-\x1b\x7f-\x{84}\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
    r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]]]"
)
WORD = WORD_CHAR + "+"
# One character of white space (same set).
BLANK_CHAR = r"[ \n[\t\x0b-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"

# Texts with no white space but spaces and newlines, most of them; runs of few ranges are read fastest.
SIMPLE_TEXT = r"\A[ -~\n]*(?:[\x{a1}-\x{167f}[\x{200b}-\x{2027}\x{3001}-\x{10ffff}]]+[ -~\n]*)*+\z"

# Characters other than the plain newline that also end a line.
OTHER_LINE_END = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x85[\x{2028}\x{2029}]]"

# Tokens are words * 13 / 10, rounded down.
TOKENS_PER_10_WORDS = 13

# The three known site forms and the order in which each stage tries them.
SITE_WIKI = "playblackdesert.com"
SITE_BLOG = "blackdesertfoundry.com"
SITE_TOOL = "garmoth.com"
STAGE_ORDER = {
    "fetch": (SITE_BLOG, SITE_TOOL, SITE_WIKI),
    "date": (SITE_WIKI, SITE_BLOG, SITE_TOOL),
    "clean": (SITE_TOOL, SITE_WIKI, SITE_BLOG),
    "chunk": (SITE_WIKI, SITE_BLOG, SITE_TOOL),
}
FETCH_STRATEGY = {SITE_BLOG: "converter", SITE_TOOL: "converter_post", SITE_WIKI: "converter_post"}

# Where each site form states its date (group 1).
DATE_WIKI = r"(?i)(?d)Last Edited on\s*:\s*(.*?)\s+Share"
DATE_BLOG = r"(?im)(?d)\*\*Last Updated:\*\*\s*(.*?)(?:\s*\||\s*$)"
DATE_TOOL = r"(?im)(?d)Updated:\s*(.*?)(?:\s*\||\s*$)"

# Wiki page header (group 1 is the title) and footer markers.
WIKI_HEADER = (
    r"(?m)(?d)^###\s+(.+?)\s+Request Edit\s*\r?\n+"
    r"\s*Last Edited on\s*:\s*.+?Share\s*\r?\n+"
    r"\s*Copy URL Facebook X\s*\r?\n*"
)
WIKI_FOOTER_LINES = (
    r"^_*The content of the game guide may differ from the actual game content",
    r"^###\s*Request Edit\b",
    r"^Close Request to Update\b",
    r"^Send Request to Update\b",
)
WIKI_SOCIAL_LINE = r"^[^\S\n]*(?:Share|Copy URL|Facebook|Instagram|Twitch|Twitter|Youtube|Discord|TikTok)"
WIKI_RATING_LINE = r"^\[!\[Image"

# Blog page title lines, opening, boilerplate and closing markers.
BLOG_SUFFIX = "BDFoundry"
BLOG_TITLES = (
    r"(?m)(?d)^Title:\s*(.+?)\s*-\s*BDFoundry\s*$",
    r"(?m)(?d)^(.+?)\s*-\s*BDFoundry\s*$",
)
BLOG_HEADER_LINES = (
    r"^Title:.*?-\s*BDFoundry\s*$",
    r"^Description:.*$",
    r"^Skip to content\s*$",
)
BLOG_BREADCRUMB = r"(?ims)(?d)^(?:\*\*Last Updated:\*\*|You are here:).*?(?=^#|^Introduction|\z)"
BLOG_DISCLAIMER = "The content of the game guide may differ from the actual game content"
BLOG_QUICK_LINKS = (
    r"(?ims)(?d)^\s*+(?:####\s*Quick\s+Links|\*\*Navigation\*\*\s*Hide)\s*$"
    r".+?(?=^\s*+(?:##|\[By|Introduction|\z)|(?<=\n)\z)"
)
BLOG_QUICK_MARK = r"(?i)Quick\s+Links|\*\*Navigation\*\*"
BLOG_CLOSING = (
    r"(?im)(?d)^[^\S\n]*(?:\[By\s+[^\]]+\]\(.*?\)|###\s+Check\s+these\s+out\s+before\s+you\s+go!\s*$)"
)
INTRODUCTION = (
    r"(?im)(?d)^Introduction\s*[\r\n]+[-=]{3,}",
    r"(?im)(?d)^##\s+Introduction\s*$",
    r"(?im)(?d)^###\s+Introduction\s*$",
    r"(?im)(?d)^####\s+Introduction\s*$",
)

# Tool page title line, opening, by-line and closing marker.
TOOL_SUFFIX = "Garmoth.com"
TOOL_TITLE = (
    r"(?m)(?d)^(.+?)\s*\|\s*Guide\s*\|\s*Garmoth\.com\s*-\s*BDO\s*Companion\s*$"
)
TOOL_INTRODUCTION = (r"(?im)(?d)^1\.\s+Introduction\s*$",) + INTRODUCTION[1:]
TOOL_BY_LINE = r"^!\[.*?\]\(.*?\)\s*By\s+.*$"
TOOL_CLOSING = r"(?im)(?d)^[^\n]*Let\s+us\s+know!"

# Title of a page whose site form states none.
UNKNOWN_TITLE = "Unknown"

# Markdown forms.
# A bracket from which no link can be completed is matched together with what no later bracket could complete
# either, and is put back or skipped; so no text is searched twice.
INLINE_LINK = r"(?d)\[(?>.*?\]\()(?>.*?\))|(\[.*)"
LINK_TARGET = r'(?<!!)\[[^\]]*+(?:\]\((https?://[^\s)]++)(?:\s+"[^"]*")?\))?+'
TITLE_LINES = (
    r"(?m)(?d)^#[^\S\n]+(\S.*)$",
    r"(?m)(?d)^##[^\S\n]+(\S.*)$",
    r"(?m)(?d)^###[^\S\n]+(\S.*)$",
    r"(?m)(?d)^Title:[^\S\n]*(\S.*)$",
)
# A chunk that opens with a heading; the wide form also takes numbered lines.
HEADING_START = r"(?m)(?d)\A(?:#{1,6}[^\S\n]+\S|[^\s#][^\n]+\n[-=]{3,}[^\S\n]*$)"
HEADING_START_WIDE = (
    r"(?m)(?d)\A(?:#{1,6}[^\S\n]+\S|[^\n]+\n[-=]{3,}[^\S\n]*$|\d+\.[^\S\n]+\S)"
)
# First heading line of a chunk, with its underline.
MAIN_HEADING = (
    r"(?m)(?d)^(?:[^\S\n]*#{1,6}[^\S\n][^\n]*|[^\S\n]*\S[^\n]*\n[^\S\n]*[-=]{3,}[^\S\n]*)$"
)
DEFAULT_HEADING = "## Content Section"
DEFAULT_CONTEXT = "Guide Section"
SENTENCE_END = r"(?<=[.!?])\s+"

# Markdown to plain text, rewrites in the order they are applied. After
# pattern and replacement come texts; where none of them occurs the pattern cannot match.
# LINE_START skips line starts after an empty line: the start of that line gave the same answer.
LINE_START = r"(?m)(?d)^(?:\G|(?<!\n\n))"
PLAIN_INLINE = (
    (r"(?s)```.*?```", "", "```"),
    (r"`([^`]*)`", "$1", "`"),
    (r"!\[([^\]]*+)\]\([^\)]*+\)|(!\[[^\]]*+(?:\]\([^\)]*+\z)?+)", "$1$2", "!["),
    (r"\[([^\]]++)\]\([^\)]++\)|(\[[^\]]*+(?:\]\([^\)]*+\z)?+)", "$1$2", "]("),
    (r"(?s)\*\*(.*?)\*\*", "$1", "**"),
    (r"(?s)__(.*?)__", "$1", "__"),
    (r"(?s)\*(.*?)\*", "$1", "*"),
    (r"(?s)_(.*?)_", "$1", "_"),
    (r"(?m)(?d)^\s{0,3}#{1,6}\s+", "", "#"),
    (r"(?m)(?d)^([A-Za-z][^\n]*)\n[-=]{3,}\s*$", "$1", "\n-", "\n="),
    (LINE_START + r"\s*+[-*+]\s+", "- ", "-", "*", "+"),
    (LINE_START + r"\s*+\d+\.\s+", "- ", "."),
)
# The corrected form: lists before emphasis, emphasis within a line and not inside a word, table rules with colons.
# Marks of a word by underscores take the character on both sides along, so neighbours need a second pass.
_WORD_EMPHASIS = r"(?m)(?d)(^|[^\p{L}\p{N}_])_([^\s_](?:[^_\n]*[^\s_])?)_([^\p{L}\p{N}_]|$)"
PLAIN_EMPHASIS_SAFE = (
    (r"\*\*([^\s*](?:[^*\n]*[^\s*])?)\*\*", "$1", "**"),
    (r"__([^\s_](?:[^_\n]*[^\s_])?)__", "$1", "__"),
    (r"\*([^\s*](?:[^*\n]*[^\s*])?)\*", "$1", "*"),
    (_WORD_EMPHASIS, "$1$2$3", "_"),
    (_WORD_EMPHASIS, "$1$2$3", "_"),
)
PLAIN_INLINE_SAFE = PLAIN_INLINE[:4] + PLAIN_INLINE[8:] + PLAIN_EMPHASIS_SAFE
PLAIN_TABLE_RULE_SAFE = r"^\|?\s*:?-+:?\s*(?:\|\s*:?-+:?\s*)++\|?$"
PLAIN_TABLE_RULE = r"^\|?\s*-+\s*(?:\|\s*-+\s*)++\|?$"
PLAIN_CLEANUP = (
    (r"\\([\\`*_{}\[\]()#+\-\.!\"'])", "$1", "\\"),
    (LINE_START + r"\s*+[*]{3,}\s*$", "", "***"),
    (LINE_START + r"\s*+[-]{3,}\s*$", "", "---"),
    (LINE_START + r"\s*+=_+\s*$", "", "=_"),
    (LINE_START + r"\s*+Image\s+\d+\s*$", "", "Image"),
    (LINE_START + r"\s*+Request Edit\s*$", "", "Request Edit"),
    (r"\t", " ", "\t"),
    (r" {2,}", " ", "  "),
    (r"\n{3,}", "\n\n", "\n\n\n"),
)

# List and table line forms.
LIST_ITEM_LINE = r"^(?:[*+\-]|\d+\.)\s+[\p{L}\p{N}_]"
STAR_LINE = r"^\*\s+"
MAIN_BULLET_LINE = r"^\*\s+[\p{L}\p{N}_\[]"
NESTED_LINE = r"^\s{2,}\*\s+"
INDENTED_STAR_LINE = r"^\s+\*\s+"
TABLE_RULE_LINE = r"^\|[\s|:]*-[\s|:\-]*$"
PART_MARKER_START = "**[Part "
PART_MARKER = r"\*\*\[Part \d+ of \d+(?:\s+-\s+Continued)?\]\*\*"

# Page record separators and headers of the plain-text corpus.
BLOCK_RULE = "=" * 80
BLOCK_PADDING = "\n" * 4

# Model answers may be fenced, and may hold escapes that JSON does not know.
OPENING_FENCE = r"\A```(?:json)?\s*"
CLOSING_FENCE = r"\s*```\z"
BAD_ESCAPE = r'\\(?!["\\/bfnrtu])'
BAD_UNICODE_ESCAPE = r"\\u(?![0-9a-fA-F]{4})"

# Words that mark a question about the text itself.
META_QUESTION_WORDS = (
    "text", "passage", "paragraph", "document", "section",
    "article", "prompt", "sentence", "source",
)

# A short neutral prompt; callers pass their own text with {context} in it.
DEFAULT_TEMPLATE = (
    "Write questions and answers about the guide below.\n"
    "Use only what it says.\n\n{context}\n\nSource:"
)
