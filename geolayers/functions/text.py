"""Text of a declared encoding to Spark strings."""

import codecs
import re

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# Database spellings of encodings and their standard names.
ENCODING_NAMES = {
    "LATIN1": "ISO-8859-1",
    "LATIN2": "ISO-8859-2",
    "LATIN3": "ISO-8859-3",
    "LATIN4": "ISO-8859-4",
    "LATIN5": "ISO-8859-9",
    "LATIN6": "ISO-8859-10",
    "LATIN7": "ISO-8859-13",
    "LATIN8": "ISO-8859-14",
    "LATIN9": "ISO-8859-15",
    "LATIN10": "ISO-8859-16",
    "SQL_ASCII": "UTF-8",
    "UTF8": "UTF-8",
    "UNICODE": "UTF-8",
    "WIN866": "cp866",
    "WIN874": "cp874",
    "WIN1250": "windows-1250",
    "WIN1251": "windows-1251",
    "WIN1252": "windows-1252",
    "WIN1253": "windows-1253",
    "WIN1254": "windows-1254",
    "WIN1255": "windows-1255",
    "WIN1256": "windows-1256",
    "WIN1257": "windows-1257",
    "WIN1258": "windows-1258",
    "KOI8R": "koi8-r",
    "KOI8U": "koi8-u",
    "SJIS": "shift_jis",
    "EUC_JP": "euc_jp",
    "EUC_KR": "euc_kr",
    "EUC_CN": "gb2312",
    "GBK": "gbk",
    "GB18030": "gb18030",
    "BIG5": "big5",
    "UHC": "cp949",
    "JOHAB": "johab",
}

# Charsets that Spark's own decode() accepts with default settings.
SPARK_CHARSETS = {"ISO-8859-1", "US-ASCII", "UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"}


def charset(encoding: str) -> str:
    """Standard name of an encoding; unknown names are an error."""
    key = encoding.strip().upper()
    page = re.fullmatch(r"(?:ANSI|OEM|CP|WINDOWS|IBM)?[ _-]*(\d{3,5})", key)  # the spellings of .cpg files
    if page:
        number = int(page[1])
        key = {65001: "UTF-8", 28591: "ISO-8859-1"}.get(number, f"CP{number}")
        key = f"ISO-8859-{number - 88590}" if 88591 <= number <= 88599 else key
    name = ENCODING_NAMES.get(key, ENCODING_NAMES.get(key.replace("-", "").replace("_", ""), key))
    codecs.lookup(name)
    return name


def transcode(text: Column, encoding: str, utf8_layer: bool = False) -> Column:
    """Decode a binary column.  A layer known to be UTF-8 ignores the encoding."""
    name = "UTF-8" if utf8_layer else charset(encoding)
    if name.upper() in SPARK_CHARSETS:
        return F.decode(text, name.upper())

    @F.arrow_udf(T.StringType())
    def decode(values: pa.Array) -> pa.Array:
        coded = values.dictionary_encode()  # each different text is decoded once
        texts = pa.array([v.decode(name) for v in coded.dictionary.to_pylist()], pa.string())
        return texts.take(coded.indices)

    return decode(text)
