"""The text operators' queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from seqtables.llm import bytepairs, codesearch, collocations, fixity, jaccard, langid, mixing, packing, repair, suffixes, syncmers, tokenfiles, toxicity
from seqtables.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_codesearch(spark, sf):
    return codesearch.search(spark.read.parquet(f"{sf}/embeddings.parquet"))


ORACLES["op1_codesearch"] = codesearch.oracle()


@query
def op2_suffixes(spark, sf):
    return suffixes.repeated_spans(documents(spark, sf))


@query
def op3_langid(spark, sf):
    docs = documents(spark, sf)
    return langid.identify(docs, langid.fit(docs))


@query
def op4_packing(spark, sf):
    return packing.pack(documents(spark, sf))


@query
def op5_mixing(spark, sf):
    return mixing.mix(documents(spark, sf))


ORACLES["op5_mixing"] = mixing.oracle()


@query
def op6_jaccard(spark, sf):
    return jaccard.join(documents(spark, sf))


@query
def op7_toxicity(spark, sf):
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")))


@query
def op8_fixity(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return fixity.audit(fixity.records(pages), fixity.records(fixity.damaged(pages)))


ORACLES["op8_fixity"] = fixity.oracle()


@query
def op9_tokenfiles(spark, sf):
    folder = tokenfiles.write(documents(spark, sf))
    return tokenfiles.read(spark, folder).drop("ids")


@query
def op10_syncmers(spark, sf):
    return syncmers.fingerprints(documents(spark, sf))


@query
def op11_repair(spark, sf):
    return repair.audit(repair.damaged(spark.read.parquet(f"{sf}/conversations.parquet")))


@query
def op12_bytepairs(spark, sf):
    return bytepairs.digests(bytepairs.encode(documents(spark, sf)))


@query
def op13_collocations(spark, sf):
    return collocations.mine(documents(spark, sf))


ORACLES["op13_collocations"] = collocations.oracle()


@query
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
