"""String and URL functions: Column to Column, null in gives null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"
#: Marker line after a text that was cut.
CUT_MARK = "[...]"
#: Words that are no key concepts, prompt wordings and styles (fixed values).
STOP_WORDS = ["tại", "sao", "vì", "khi", "qua", "hơn", "với", "của", "các", "đó", "này"]
STYLES = {
    "flat": "clean, flat illustration style with vibrant colors and simple background",
    "infographic": "educational infographic style with labeled diagrams and clear visual hierarchy",
    "cartoon": "friendly cartoon style with expressive characters and bright colors",
    "minimal": "minimalist design with essential elements only and subtle color palette",
    "realistic": "realistic illustration style with detailed rendering and natural lighting",
}
PROMPT = (
    'Create an educational illustration that explains: Câu hỏi: "%s" Trả lời: "%s". Style: %s. '
    "The image should show core concepts including %s with clear visual explanation that helps understand the relationship "
    "between the question and answer."
)
NOTHING = "Không có"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Script text for reading aloud: control characters go, then white space collapses, then symbols that no file name
    may hold go; what is blank then is null. In this order a line break between words joins them."""
    visible = F.regexp_replace(c, r"\p{C}", "")
    spaced = F.regexp_replace(visible, r"(?U)\s+", " ")
    return blank_to_null(F.trim(F.regexp_replace(spaced, r'[\\/*?:"<>|]', "")))


def fenced_json(c: Column) -> Column:
    """The content of the first ```json block, else the text as it is."""
    pattern = f"(?s){FENCE}json\\n(.*?)\\n{FENCE}"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c)


def unfenced(c: Column) -> Column:
    """Without a leading ```json and a trailing ```, trimmed."""
    head = F.when(c.startswith(f"{FENCE}json"), F.substring(c, 8, 2**31 - 1)).otherwise(c)
    tail = F.when(head.endswith(FENCE), F.left(head, F.length(head) - 3)).otherwise(head)
    return F.btrim(tail, F.lit(" \t\r\n"))


def _with_scheme(c: Column) -> Column:
    bare = F.regexp_replace(c, "^@+", "")
    return F.when(bare.rlike("^https?://"), bare).otherwise(F.concat(F.lit("https://"), bare))


def video_id(c: Column) -> Column:
    """The video of a watch or short URL; null for any other. Leading @ go, a missing scheme is added."""
    url = _with_scheme(c)
    host, path = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.try_parse_url(url, F.lit("PATH"))
    watched = F.when(path == "/watch", blank_to_null(F.try_parse_url(url, F.lit("QUERY"), F.lit("v"))))
    return F.when(host.isin("www.youtube.com", "youtube.com"), watched).when(host == "youtu.be", F.regexp_replace(path, "^/+", ""))


def decoded_url(c: Column) -> Column:
    """Percent-decoded again and again until nothing changes; what can't be decoded stays. A plus stays a plus.

    Each round takes one level off every %25, so there are no more rounds that change anything than the text has such
    pieces, and one; a text without a percent sign is done at once."""
    plain = lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)
    rounds = (F.length(c) - F.length(F.replace(c, F.lit("25"), F.lit("")))) / 2 + 1
    return F.aggregate(F.sequence(F.lit(1), rounds.cast("int")), c, lambda x, _: F.when(x.contains("%"), plain(x)).otherwise(x))


def playlist_id(c: Column) -> Column:
    """The playlist of a URL of the video site: its list parameter or a /playlist/ path; null without one."""
    url = decoded_url(F.trim(c))
    ours = url.rlike(r"(youtube\.com|youtu\.be)") | url.rlike("^(https?:)?//")
    listed = F.regexp_extract(url, r"[?&]list=([A-Za-z0-9_-]{2,34})(?![A-Za-z0-9_-])", 1)
    capped = F.regexp_extract(url, r"(?i)[?&]list=([A-Za-z0-9_-]{2,34})", 1)
    by_path = F.regexp_extract(url, r"(?i)/playlist/([A-Za-z0-9_-]{2,34})", 1)
    return F.when(ours, F.coalesce(*map(blank_to_null, (listed, capped, by_path))))


def channel_ref(c: Column) -> Column:
    """struct(ref_type, ref_value): a raw channel id, or what a channel URL names by channel/, c/, user/ or @."""
    url, site = F.trim(c), r"youtube\.com/"
    found = F.when(url.rlike("^[A-Za-z0-9_-]{24,}$"), F.struct(F.lit("channel").alias("ref_type"), url.alias("ref_value")))
    for kind, pattern in (("channel", "channel/([A-Za-z0-9_-]{24})"), ("custom", "c/([A-Za-z0-9_-]+)"), ("user", "user/([A-Za-z0-9_-]+)"), ("handle", "@([A-Za-z0-9_-]+)")):
        found = found.when(url.rlike(site + pattern), F.struct(F.lit(kind).alias("ref_type"), F.regexp_extract(url, site + pattern, 1).alias("ref_value")))
    return found


def channel_id_in_page(html: Column) -> Column:
    """The channel id that a landed page states."""
    return blank_to_null(F.regexp_extract(html, '"channelId":"(UC[A-Za-z0-9_-]{22})"', 1))


def watch_url(video: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video)


def video_file(user: Column, video: Column) -> Column:
    return F.format_string("%s_%s.mp4", user, video)


def user_name(url: Column) -> Column:
    """What stands between @ and the next slash; null without @."""
    return blank_to_null(F.split_part(F.split_part(url, F.lit("@"), F.lit(2)), F.lit("/"), F.lit(1)))


def capped(c: Column, most: int = 95_000, mark: str = CUT_MARK) -> Column:
    """At most `most` characters, then a marker line where something was cut."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("\n" + mark))).otherwise(c)


def base_name(name: Column, copy_prefix: str = "Bản sao của ") -> Column:
    """A file's name without the prefix of copies and without its last extension."""
    return F.regexp_replace(F.replace(name, F.lit(copy_prefix), F.lit("")), r"(?<=[^.])\.[^.]*$", "")


def comment_line(user: Column, text: Column) -> Column:
    """[user] and [text] on two lines; null counts as empty."""
    return F.concat(F.lit("["), F.coalesce(user, F.lit("")), F.lit("]\n["), F.coalesce(text, F.lit("")), F.lit("]"))


def or_nothing(c: Column, default: str = NOTHING) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def content_prompt(post: Column, transcript: Column, comments: Column) -> Column:
    """The request about a post; a missing transcript or comments are named as missing."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Post: "), F.coalesce(post, F.lit(""))),
        F.concat(F.lit("Transcript: "), or_nothing(transcript)),
        F.concat(F.lit("Comments: "), or_nothing(comments)),
    )


def key_concepts(text: Column, most: int = 5) -> Column:
    """The first `most` words of over three letters that are no stop words, repeats removed, in order of appearance."""
    words = F.filter(F.split(F.lower(F.trim(text)), r"\s+"), lambda w: (F.length(w) > 3) & ~w.isin(STOP_WORDS))
    return F.array_distinct(F.slice(words, 1, most))


def image_prompt(question: Column, answer: Column, style: str = "flat") -> Column:
    """The image request of a question and its answer; null where either is blank. An unknown style is `flat`."""
    concepts = F.array_join(key_concepts(F.concat_ws(" ", question, answer)), ", ")
    made = F.format_string(PROMPT, question, answer, F.lit(STYLES.get(style, STYLES["flat"])), concepts)
    return F.when((F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != ""), made)


def preview(c: Column, most: int = 100) -> Column:
    return F.substring(c, 1, most)
