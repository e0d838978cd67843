"""Language identification by fusing evidence.

Four kinds of evidence about a record's language are combined as a Bayesian
posterior: the likelihood of its text under byte-trigram models, the language
its markup declares, the suffix of its address, and a prior of its host. How
far declarations and suffixes can be trusted, and the priors, come from
grouped counts of the text decisions of all records: a host's prior is
smoothed towards its domain's and that towards the prior of all records, and
a record's own decision is taken out of its host's and domain's counts.

The text models are fitted to labelled documents: of every language the
distinct texts with the lowest hashes, about `TRAIN_DOCS` of them (all of a
language that has no more), so neither copies nor common languages push a rare
language out; the sample is bounded by that times the languages. Likelihoods of neighbouring trigrams are far from
independent, so a text counts as at most `TEXT_WEIGHT` trigrams of its mean.

Defined cases: without text the other evidence decides, without any of it the
overall prior; null hosts share no counts; null ids are carried; repeated rows
stay; languages are those of the training documents; without training
documents the language is null.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import map_batches, stage

TRAIN_DOCS = 4000       # distinct texts of a language
TRAIN_TASKS = 4
CELLS = 1 << 16
TEXT_WEIGHT = 40.0
HOST_SMOOTHING, DOMAIN_SMOOTHING = 8.0, 16.0
MIN_BYTES = 12          # shorter texts decide nothing that is counted
SURE = 2.0              # decisions are counted where the best language leads by so much

_MARKUP = re.compile(r"(?i)<(?:(!--)|(script|style|nav|footer|noscript)\b)?")
_CLOSES = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "nav", "footer", "noscript")} | {"!--": re.compile("-->")}
# Each match takes a whole comment or <html> tag, so a page is read once at most.
_HTML = re.compile(r"(?is)<!--(?:-?>|.*?(?:-->|\Z))|<html\b([^>]*)")
_LANG = re.compile(r"""(?i)\blang\s*=\s*["']?([a-z]{2,3})""")
_SPACE = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def visible(html: str) -> str:
    """The text outside tags, comments and the elements above; where one of these never ends, only its tag goes.

    What has no end is looked for once, so the time is linear in the page.
    """
    out, at, last, endless = [], 0, html.rfind(">"), set()
    while at <= last and (found := _MARKUP.search(html, at, last + 1)):
        out.append(html[at:found.start()])
        name, close = (found.group(1) or found.group(2) or "").lower(), None
        if name and name not in endless:
            close = _CLOSES[name].search(html, found.end())
            if not close:
                endless.add(name)
        at = close.end() if close else html.find(">", found.start()) + 1
    out.append(html[at:])
    return entities.unescape(" ".join(out))


def declared_language(html: str) -> str | None:
    """The language of the first <html> tag that names one, wherever it stands outside comments."""
    for tag in _HTML.finditer(html):
        found = _LANG.search(tag.group(1) or "")
        if found:
            return found.group(1).lower()[:2]
    return None


def trigrams(text: str) -> np.ndarray:
    """Cells of the byte trigrams of the lower-cased text; runs of ASCII non-letters are one space."""
    raw = np.frombuffer(b" " + _SPACE.sub(b" ", text.lower().encode()).strip() + b" ", np.uint8).astype(np.uint32)
    if len(raw) < MIN_BYTES:
        return np.empty(0, np.uint32)
    return ((raw[:-2] * np.uint32(0x9E3779B1)) ^ (raw[1:-1] * np.uint32(0x85EBCA77)) ^ (raw[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(16)


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix)."""
    try:
        host = (urlsplit(url or "").hostname or "").strip(".")
    except ValueError:
        host = ""
    if not host:
        return None, None, None
    parts = host.split(".")
    return host, ".".join(parts[-2:]), parts[-1]


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each cell) from about `most` distinct texts of each language, all where it has no more."""
    rows = labelled.select(labelled[text_col].cast("string").alias("text"), labelled[lang_col].cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    sizes = rows.select("lang", "h").distinct().groupBy("lang").count().collect()  # a row per language
    # Hashes are even, so a language's share below its cut is about `most` of its texts; no task ranks a whole language.
    cuts = [(lang, min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * min(1.0, most / n)))) for lang, n in sizes]
    cuts = labelled.sparkSession.createDataFrame(cuts, "lang string, cut long")
    sample = rows.join(F.broadcast(cuts), "lang").where("h <= cut").dropDuplicates(["lang", "h"]).coalesce(TRAIN_TASKS)  # each gives one row of cells per language

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                held[lang] = held.get(lang, 0) + np.bincount(trigrams(text), minlength=CELLS)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([c.astype(np.int64).tobytes() for c in held.values()])], names=["lang", "cells"])
    total: dict[str, np.ndarray] = {}
    for lang, cells in sample.mapInArrow(count, "lang string, cells binary").collect():
        total[lang] = total.get(lang, 0) + np.frombuffer(cells, np.int64)
    langs = sorted(total)
    cells = np.array([total[x] for x in langs], float).reshape(len(langs), CELLS) + 0.5
    return langs, np.log(cells / cells.sum(1, keepdims=True)).astype(np.float32)


def _sum(columns) -> Column:
    out = F.lit(0.0)
    for c in columns:
        out = out + c
    return out


def identify(records: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """(key, id, lang, posterior, text_lang, declared, host) of records (key, id, text, html, url, host).

    Where html is given, text, declaration and address are read from it and
    the url; else `text` and `host` are taken as they are.
    """
    if not langs:
        return records.select("key", "id", *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("posterior", "double"), ("text_lang", "string"), ("declared", "string"))], "host")
    shared = records.sparkSession.sparkContext.broadcast(logs)  # languages x cells

    def read(batch):
        table = shared.value
        out = []
        for html, text, url, host in zip(*(batch.column(c).to_pylist() for c in ("html", "text", "url", "host"))):
            declared, domain, suffix = None, host, None
            if html is not None or url is not None:
                declared = declared_language(html or "")
                host, domain, suffix = address(url)
                text = visible(html or "")
            cells = trigrams(text or "")
            score = table[:, cells].sum(1, dtype=np.float64) * (min(TEXT_WEIGHT, len(cells)) / len(cells)) if len(cells) else np.zeros(len(table))
            order = np.sort(score)
            best = int(score.argmax()) if len(cells) else None
            sure = best is not None and (len(order) < 2 or order[-1] - order[-2] >= SURE)
            out.append((best, best if sure else None, score.tolist(), declared, host, domain, suffix))
        types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.string(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), *[pa.array([r[i] for r in out], t) for i, t in enumerate(types)]],
                                          names=["key", "id", "best", "sure", "score", "declared", "host", "domain", "suffix"])
    size = F.coalesce(F.col("html"), F.col("text"))
    scored = map_batches(records.select("key", "id", "text", "html", "url", "host").withColumn("size", size), read,
                         "key string, id long, best int, sure int, score array<double>, declared string, host string, domain string, suffix string", "size")
    scored = stage(scored, "scores")
    n, known = len(langs), range(len(langs))
    counts = lambda df, *keys: df.groupBy(*keys).agg(*[F.sum(F.when(F.col("sure") == i, 1).otherwise(0)).alias(f"n{i}") for i in known])
    overall = [float(x or 0) for x in scored.agg(*[F.sum(F.when(F.col("sure") == i, 1).otherwise(0)) for i in known]).first()]
    overall = [(x + 1.0) / (sum(overall) + n) for x in overall]
    # Declarations outside the known languages say nothing, so their table is bounded.
    declared = {r[0]: [float(x) for x in r[1:]] for r in counts(scored.where(F.col("declared").isin(langs)), "declared").collect()}
    # Suffix, domain and host counts are joined as tables; a host names its domain and suffix.
    suffixes = counts(scored.where("suffix IS NOT NULL"), "suffix").withColumnsRenamed({f"n{i}": f"s{i}" for i in known})
    domains = counts(scored.where("domain IS NOT NULL"), "domain").withColumnsRenamed({f"n{i}": f"d{i}" for i in known})
    hosts = counts(scored.where("host IS NOT NULL"), "host", "domain", "suffix").withColumnsRenamed({f"n{i}": f"h{i}" for i in known})
    hosts = hosts.join(domains, "domain", "left").join(suffixes, "suffix", "left").drop("domain", "suffix")
    suffix_total = [float(x or 0) for x in suffixes.agg(*[F.sum(f"s{i}") for i in known]).first()]
    rows = scored.join(hosts, "host", "left")
    own = lambda i: F.when(F.col("sure") == i, 1).otherwise(0)
    count = lambda p, i: F.greatest(F.coalesce(f"{p}{i}", F.lit(0)) - own(i), F.lit(0)).cast("double")
    domain_all, host_all = (_sum(count(p, i) for i in known) for p in "dh")
    logs_by_lang = []
    for i in known:
        domain = (count("d", i) + F.lit(DOMAIN_SMOOTHING * overall[i])) / (domain_all + F.lit(DOMAIN_SMOOTHING))
        prior = (count("h", i) + F.lit(HOST_SMOOTHING) * domain) / (host_all + F.lit(HOST_SMOOTHING))
        # P(suffix | language), against its share of all records: 0 where no suffix is known.
        seen = (F.coalesce(f"s{i}", F.lit(0)) + F.lit(4.0 * overall[i])) / F.lit(suffix_total[i] + 4.0 * overall[i] + 1.0)
        share = (_sum(F.coalesce(f"s{j}", F.lit(0)) for j in known) + F.lit(4.0)) / F.lit(sum(suffix_total) + 5.0)
        suffix = F.when(F.col("suffix").isNull(), F.lit(0.0)).otherwise(F.log(seen / share))
        logs_by_lang.append(F.log(prior) + F.element_at("score", i + 1) + _said(i, declared, langs) + suffix)
    rows = rows.select("key", "id", "best", "declared", "host", F.array(*logs_by_lang).alias("log"))
    rows = rows.withColumn("top", F.array_max("log"))
    total = F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    named = F.array(*[F.lit(x) for x in langs])
    return rows.select("key", "id", F.element_at(named, F.array_position("log", F.col("top")).cast("int")).alias("lang"), (F.lit(1.0) / total).alias("posterior"),
                       F.when(F.col("best").isNotNull(), F.element_at(named, F.col("best") + 1)).alias("text_lang"), "declared", "host")


def _said(i: int, declared: dict[str, list[float]], langs: list[str]) -> Column:
    """log P(declared | language i): counts of the text decisions, smoothed towards a truthful declaration; 0 if nothing known is declared."""
    total = sum(counts[i] for counts in declared.values())
    out = F.lit(0.0)
    for j, lang in enumerate(langs):
        pseudo = 4.0 if i == j else 1.0 / len(langs)
        p = (declared.get(lang, [0.0] * len(langs))[i] + pseudo) / (total + 5.0)
        out = F.when(F.col("declared") == lang, F.lit(float(np.log(p)))).otherwise(out)
    return out


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Pages by all evidence, documents by their text and the prior of their source; `lang` of a document is only read for the training sample."""
    docs, pages = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/pages.parquet")
    none = lambda c: F.lit(None).cast("string").alias(c)
    records = pages.select(F.lit("pages").alias("key"), F.col("page_id").cast("long").alias("id"), none("text"), "html", "url", none("host")).unionByName(
        docs.select(F.lit("documents").alias("key"), F.col("doc_id").cast("long").alias("id"), "text", none("html"), none("url"), F.col("source").alias("host")))
    found = identify(records, *train(docs))
    return found.select(F.when(F.col("key") == "pages", F.col("id")).alias("page_id"), F.when(F.col("key") == "documents", F.col("id")).alias("doc_id"),
                        "lang", F.round("posterior", 6).alias("posterior"), "text_lang", "declared", "host")
