"""Text functions as Column expressions: sentences, languages, marks, times, JSON answers, prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentence punctuation, without the space and the full stop.
PUNCTUATION = r'[，,。！？!?…、；;：:（）()"《》<>【】\[\]]+'
# Language names that a speech recogniser writes, and their codes.
LANGUAGE_CODES = {
    "chinese": "zh", "cantonese": "yue", "japanese": "ja", "korean": "ko", "english": "en", "arabic": "ar", "german": "de", "french": "fr", "spanish": "es", "portuguese": "pt",
    "russian": "ru", "italian": "it", "thai": "th", "vietnamese": "vi", "indonesian": "id", "malay": "ms", "turkish": "tr", "hindi": "hi", "dutch": "nl", "swedish": "sv", "polish": "pl",
    "czech": "cs", "filipino": "fil", "persian": "fa", "greek": "el", "romanian": "ro", "hungarian": "hu", "ukrainian": "uk", "bengali": "bn", "nepali": "ne", "urdu": "ur",
}
COLON = "："


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$", "")


def split_sentences(text: Column) -> Column:
    """parts between punctuation, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, PUNCTUATION), strip), lambda x: x != "")


def count_class(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{chars}]", ""))


def guess_language(text: Column) -> Column:
    """kana make ja, then hangul ko, then at least as many han as Latin letters zh, else en."""
    kana, hangul = count_class(text, r"\x{3040}-\x{30FF}"), count_class(text, r"\x{AC00}-\x{D7AF}")
    han, latin = count_class(text, r"\x{4E00}-\x{9FFF}"), count_class(text, "A-Za-z")
    return F.when(kana > 0, "ja").when(hangul > 0, "ko").when(han >= latin, "zh").otherwise("en")


def parse_asr(raw: Column) -> Column:
    """struct(lang, text) of `language X<asr_text>...`; lang is null where there is none or it's unknown."""
    t = strip(F.coalesce(raw, F.lit("")))
    name = F.lower(F.regexp_extract(t, r"^language\s+([A-Za-z]+)", 1))
    codes = F.create_map(*[F.lit(x) for kv in LANGUAGE_CODES.items() for x in kv])
    rest = F.regexp_replace(t, r"^language\s+[A-Za-z]+", "")
    body = F.regexp_replace(rest, r"(?s)^<asr_text>", "")
    return F.struct(F.try_element_at(codes, F.when(name != "", name)).alias("lang"), strip(F.regexp_replace(body, r"<\|[^|]+\|>", "")).alias("text"))


def make_mark(video: Column, frame: Column, cluster: Column | None = None, key: bool = False) -> Column:
    """`<video>_f<frame>`, with `_c<NNN>` and `key` for members of clusters."""
    head = F.concat(video, F.lit("_f"), frame.cast("string"))
    return head if cluster is None else F.concat(head, F.format_string("_c%03d" + ("key" if key else ""), cluster))


def parse_mark(mark: Column) -> Column:
    """struct(video, frame, cluster, is_key, rep_video, rep_frame) of a mark; the representative is named after
    the last full-width colon, and is the frame itself where there is none."""
    head, tail = F.element_at(F.split(mark, COLON), 1), F.element_at(F.split(mark, COLON), -1)
    last = F.element_at(F.split(head, "_"), -1)
    num = lambda c, p: F.regexp_extract(c, p, 1).try_cast("int")
    return F.struct(
        F.regexp_extract(head, r"^(.+?)_f\d+", 1).alias("video"), num(head, r"_f(\d+)").alias("frame"), num(head, r"_c(\d+)(?:key)?$").alias("cluster"),
        last.rlike("^c?.*key$").alias("is_key"), F.regexp_extract(tail, r"^(.+?)_f\d+", 1).alias("rep_video"), num(tail, r"_f(\d+)").alias("rep_frame"),
    )


def is_cluster_key(mark: Column) -> Column:
    """The last part of a mark's head is `c...key`."""
    return F.element_at(F.split(F.element_at(F.split(mark, COLON), 1), "_"), -1).rlike("^c.*key$")


def segment_mark(mark: Column) -> Column:
    """A mark as segments hold it: single frames get `_key`, keys stay, members lose their reference."""
    return F.when(mark.contains(COLON), F.element_at(F.split(mark, COLON), 1)).when(is_cluster_key(mark), mark).otherwise(F.concat(mark, F.lit("_key")))


def numbered_entries(text: Column) -> Column:
    """map from number to text of `1|.. 2|..`; of a repeated number the last entry counts."""
    numbers = F.regexp_extract_all(text, F.lit(r"(?s)(\d+)\|(.*?)(?=\d+\||$)"), F.lit(1))
    texts = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)(\d+)\|(.*?)(?=\d+\||$)"), F.lit(2)), strip)
    pairs = F.arrays_zip(numbers.alias("k"), texts.alias("v"))
    # an entry stays unless the same number comes again
    at = F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i")))
    return F.map_from_entries(F.transform(F.filter(at, lambda p: ~F.exists(at, lambda q: (q["k"] == p["k"]) & (q["i"] > p["i"]))), lambda p: F.struct(p["k"].cast("int"), p["v"])))


def description_line(line: Column) -> Column:
    """struct(frame, text) of `<hash>_f<n>..：text`; null where the line isn't one."""
    pattern = r"^[0-9a-f]+_f(\d+)(?:.*?[：:]\s*(.*))?$"
    return F.when(line.rlike(pattern), F.struct(F.regexp_extract(line, pattern, 1).cast("int").alias("frame"), F.regexp_extract(line, pattern, 2).alias("text")))


def split_once(text: Column, sep: str) -> Column:
    """struct(head, tail) at the first separator; without one, everything is head."""
    at = F.instr(text, sep)
    return F.struct(F.when(at > 0, F.substring_index(text, sep, 1)).otherwise(text).alias("head"), F.when(at > 0, F.substr(text, at + F.lit(len(sep)))).otherwise("").alias("tail"))


# Words of a transcript.
NOBODY, PICTURES, LINES, NOTHING = "无", "画面", "对白", "(None)"


def scene_text(scene: Column, persons: Column, pictures: Column, lines: Column) -> Column:
    """F8: a scene's paragraph of a transcript: who is there, what is seen and what is said, a line each.

    `SPK|text` is written `SPK: text`; a line without `|` stays. A scene with neither pictures nor lines says so.
    """
    listed = lambda title, rows: F.when(F.size(rows) > 0, F.concat(F.lit(f"\n  {title}:\n    "), F.array_join(rows, "\n    "))).otherwise("")
    who = F.when(F.size(persons) > 0, F.array_join(persons, ",")).otherwise(NOBODY)
    said = F.transform(lines, lambda x: F.when(F.instr(x, "|") > 0, F.concat(split_once(x, "|")["head"], F.lit(": "), split_once(x, "|")["tail"])).otherwise(x))
    nothing = F.when((F.size(pictures) > 0) | (F.size(lines) > 0), "").otherwise(f"\n  {NOTHING}")
    return F.concat(F.lit("Scene"), scene.cast("string"), F.lit(" [persons: "), who, F.lit("]"), listed(PICTURES, pictures), listed(LINES, said), nothing)


def transcript(paragraphs: Column) -> Column:
    """F8: a video's paragraphs, an empty line between them."""
    return F.array_join(paragraphs, "\n\n")


def fill_prompt(template: Column, values: dict[str, Column]) -> Column:
    """`{name}` replaced by each value, nothing else touched."""
    for k, v in values.items():
        template = F.replace(template, F.lit("{" + k + "}"), v.cast("string"))
    return template


def escape_html(text: Column) -> Column:
    """F10."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def stem(path: Column) -> Column:
    """the file name without folders and its last ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def fnv1a_24(text: Column) -> Column:
    """the low 24 bits of FNV-1a-32 over UTF-8 bytes, as six hexadecimal digits."""
    octets = F.transform(F.sequence(F.lit(0), F.octet_length(text) - 1), lambda i: F.conv(F.substr(F.hex(text.cast("binary")), i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    fold = F.aggregate(octets, F.lit(0x811C9DC5).cast("long"), lambda h, b: F.pmod(h.bitwiseXOR(b) * F.lit(0x01000193), F.lit(1 << 32)))
    return F.lower(F.lpad(F.hex(F.when(text == "", F.lit(0x811C9DC5).cast("long")).otherwise(fold).bitwiseAND(F.lit(0xFFFFFF))), 6, "0"))


def frame_to_ms(frame: Column, fps: Column | float) -> Column:
    """truncated towards zero."""
    return (frame / (F.lit(fps) if isinstance(fps, (int, float)) else fps) * 1000).cast("int")


def ms_to_frame(ms: Column, fps: Column | float) -> Column:
    """truncated towards zero; not the inverse of frame_to_ms."""
    return (ms / 1000.0 * (F.lit(float(fps)) if isinstance(fps, (int, float)) else fps)).cast("int")


def srt_ms(stamp: Column) -> Column:
    """milliseconds of `H:M:S,ms`."""
    part = lambda i: F.regexp_extract(stamp, r"(\d+):(\d+):(\d+)[,.](\d+)", i).try_cast("long")
    return ((part(1) * 60 + part(2)) * 60 + part(3)) * 1000 + part(4)


def clock(seconds: Column) -> Column:
    """m:ss of seconds, rounded (half to even)."""
    s = F.bround(seconds.cast("double"), 0).cast("long")
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def speaker_line(lang: Column, speaker: Column, text: Column) -> Column:
    """`[lang]SPK: text`; the language `none` isn't written."""
    return F.concat(F.when(lang != "none", F.concat(F.lit("["), lang, F.lit("]"))).otherwise(""), speaker, F.lit(": "), text)


def parse_boundaries(answer: Column) -> Column:
    """sorted distinct scene numbers of an answer `{"boundaries": [..]}` in any of its forms.

    Numbers, "N", "SceneN" and "a,b" (its second number) count. An array that isn't closed is closed; where the
    object can't be parsed, the second numbers of all "a,b" count.
    """
    found = F.regexp_extract(answer, r'(?s)(\{[^{}]*"boundaries"[^{}]*\})', 1)
    opened, closed = (F.char_length(found) - F.char_length(F.replace(found, F.lit(c))) for c in "[]")
    one = F.when(opened > closed, F.concat(F.regexp_replace(F.regexp_replace(found, r"\s+$", ""), r",+$", ""), F.lit("]}"))).otherwise(found)
    odd = (F.char_length(one) - F.char_length(F.replace(one, F.lit('"')))) % 2 != 0
    mended = F.when(odd, F.concat(one, F.lit('"'))).otherwise(one)
    variant = F.try_parse_json(mended)
    items = F.try_variant_get(variant, "$.boundaries", "array<string>")
    whole = r"^\s*[-+]?\d+\s*$"
    number = lambda c: F.when(c.rlike(whole), strip(c).try_cast("int"))

    def read(item: Column) -> Column:
        x = strip(item)
        parts = F.split(x, ",")
        return F.when(x.startswith("Scene"), number(F.substr(x, F.lit(6)))).when(x.contains(","), F.when(F.size(parts) == 2, number(F.element_at(parts, 2)))).otherwise(number(x))

    pairs = F.transform(F.regexp_extract_all(answer, F.lit(r'"(\d+),(\d+)"'), F.lit(2)), lambda x: x.cast("int"))
    got = F.when(found == "", F.array().cast("array<int>")).when(variant.isNull(), pairs).otherwise(F.coalesce(F.array_compact(F.transform(items, read)), F.array().cast("array<int>")))
    return F.sort_array(F.array_distinct(got))


def json_object(answer: Column) -> Column:
    """from the first `{` to the last `}`; null if there is none."""
    found = F.regexp_extract(answer, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def scene_numbers(text: Column) -> Column:
    """the numbers of all `SceneN`."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"Scene(\d+)"), F.lit(1)), lambda x: x.cast("int"))
