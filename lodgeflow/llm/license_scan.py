"""License scans by diagonal voting, in DataFrame operations only.

Every pair of consecutive words of every text is joined to the places where a
template has the same pair.  Matches of one text and template whose text place
and template place differ by the same number lie on one diagonal; each is a
vote for the template starting there.  A base phrase stands where all its
pairs vote for one diagonal.  For the longer notices, diagonals near each
other (words put in or left out) are merged and a span is accepted when it
covers enough of the notice and is not much longer.  Around a diagonal the
words are also aligned with the notice's, one character for each word, and the
place is accepted when the word edit distance of the best stretch is within a
bound: two edits from five words on, more for longer notices.  Words that tell
licences apart count for more than the bound, so they must stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: base phrases and their labels
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Creative Commons: the short and the long names of what is added to "by".
_CC = (("", ""), (" sa", " sharealike"), (" sa", " share alike"), (" nc", " noncommercial"), (" nc", " non commercial"),
       (" nd", " noderivatives"), (" nd", " noderivs"), (" nd", " no derivatives"), (" nd", " no derivs"),
       (" nc sa", " noncommercial sharealike"), (" nc sa", " noncommercial share alike"),
       (" nc sa", " non commercial share alike"), (" nc nd", " noncommercial noderivatives"),
       (" nc nd", " noncommercial noderivs"), (" nc nd", " noncommercial no derivs"),
       (" nc nd", " non commercial no derivatives"))
_CC_SHORT = ("", " sa", " nc", " nd", " nc sa", " nc nd")
#: Notices of the method, with labels of its own where the base has none.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the software", "mit"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis", "apache"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software", "bsd"),
    ("creative commons attribution license", "cc-by"),
    *((f"licensed under cc by{short} 4 0", f"cc-by{short}".replace(" ", "-")) for short in _CC_SHORT),
    *((f"cc by{short} {version}", f"cc-by{short}".replace(" ", "-"))
      for short in _CC_SHORT for version in ("1 0", "2 0", "2 5", "3 0", "4 0")),
    *((f"creative commons attribution{long} 4 0 international license", f"cc-by{short}".replace(" ", "-"))
      for short, long in _CC),
)
#: What may follow a Creative Commons licence's name and makes it another one.
_ADDED = ("sa", "nc", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs", "share", "alike", "non",
          "commercial", "derivatives", "derivs")
#: Words that tell one licence from another; an edit of one breaks the notice.
TELLING = ("mit", "apache", "lesser", "affero", "mozilla", "cc", "attribution", *_ADDED)
#: Edits that a notice of so many words bears: one word put in and one replaced,
#: and ``EDIT_SHARE`` of the words of a long one; shorter notices bear none.
EDIT_LEAST, EDIT_WORDS, EDIT_SHARE = 2, 5, 0.15
#: Pairs of words that any text is full of give no vote.
_COMMON = {"a", "an", "and", "are", "by", "in", "is", "it", "of", "or", "the", "this", "to", "under", "with", "you",
           "may", "not", "use"}
#: What separates words; A-Z are letters here and lower-cased word by word.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """(template, label, is_base, pairs, bound, notice, at, one, two): a row per
    pair of consecutive words of a template; ``bound``: edits it bears,
    ``notice``: its words.  A fixed, small table."""
    rows = []
    for k, (phrase, label) in enumerate([*base, *notices]):
        words = phrase.split()
        own = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))
               if k < len(base) or not (a in _COMMON and b in _COMMON)]
        bound = 0 if k < len(base) or len(words) < EDIT_WORDS else max(EDIT_LEAST, int(EDIT_SHARE * len(words)))
        rows += [F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(k < len(base)).alias("is_base"),
                          F.lit(len(own)).alias("pairs"), F.lit(bound).alias("bound"),
                          F.lit(phrase).alias("notice"), F.lit(i).alias("at"), F.lit(a).alias("one"),
                          F.lit(b).alias("two")) for i, a, b in own]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("pair", F.xxhash64("one", "two"))


def _same(word: Column, template: Column) -> Column:
    """Equal after lower-casing A-Z only."""
    return (F.lower(word) == template) & (F.octet_length(word) == F.octet_length(template))


def _within(window: Column, notice: Column, bound: Column) -> Column:
    """Whether some stretch of the words in ``window`` is within ``bound`` word
    edits of the notice.  A word is the character of its place in the notice
    (one of its own for all others), a telling one is so many that no edit of
    it is within the bound."""
    words, low = F.split(notice, " "), F.transform(window, F.lower)
    weight = lambda w: F.when(w.isin(*TELLING), bound + 1).otherwise(1)
    coded = lambda x: F.transform(x, lambda w: F.repeat(
        F.char(F.array_position(words, w) + 64), weight(w)))
    # every stretch begins within the bound of the diagonal and is as long as the notice, give or take the bound
    lengths = F.sequence(F.size(words) - bound, F.size(words) + bound)

    def close(x: Column, first: Column, n: Column) -> Column:
        return ((F.levenshtein(x["notice"], F.array_join(F.slice(x["there"], first, n), "")) <= bound)
                & ~F.coalesce(F.get(x["low"], first + n - 1).isin(*_ADDED), F.lit(False)))

    # an array of one element: what is in it is made once and not once a stretch
    once = F.array(F.struct(F.array_join(coded(words), "").alias("notice"), coded(low).alias("there"), low.alias("low")))
    found = F.exists(once, lambda x: F.exists(F.sequence(F.lit(1), 2 * bound + 1), lambda first: F.exists(
        lengths, lambda n: close(x, first, n))))
    enough = F.size(F.array_intersect(words, low)) >= F.size(F.array_distinct(words)) - bound
    return F.coalesce(F.when((bound > 0) & enough, found), F.lit(False))


def scan(docs: DataFrame, base=BASE, notices=NOTICES, slack: int = 4, covers: float = 0.85,
         longer: float = 1.5) -> DataFrame:
    """Per row ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    ``slack``: how far apart merged diagonals may lie; ``covers``: least share
    of a notice's pairs; ``longer``: most words of a span, as a multiple of the
    notice's; a stretch within the notice's bound of word edits is accepted as
    well.  The score is the covered share of the best accepted span (1 for a
    base phrase, 0 for none).  Null, empty and wordless texts have no words
    and no labels; repeated rows each get a row; a null ``doc_id`` is carried;
    an empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    # a generator of one element: what stands above it uses the words and doesn't split again
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                        F.explode_outer(F.array(F.split(F.coalesce("text", F.lit("")), _BETWEEN))).alias("words"))
    lead = (F.col("words")[0] == "").cast("int")  # a separator at the start or end leaves an empty word
    trail = (F.element_at("words", -1) == "").cast("int")
    each = split.select("doc_id", "row", lead.alias("lead"), "words",
                        F.greatest(F.lit(0), F.size("words") - lead - trail).alias("n_words"),
                        F.posexplode_outer("words").alias("place", "word"))
    pairs = each.select("doc_id", "row", "n_words", (F.col("place") - F.col("lead")).alias("place"),
                        (F.col("place") == 0).alias("head"), "word", "words", "lead", F.get("words", F.col("place") + 1).alias("next"))
    pairs = pairs.withColumn("pair", F.xxhash64(F.lower("word"), F.lower("next")))
    table = templates(spark, base, notices)
    # the templates are a fixed list; the left join keeps each text's first row
    hits = pairs.join(F.broadcast(table), (pairs["pair"] == table["pair"]) & _same(pairs["word"], table["one"])
                      & _same(pairs["next"], table["two"]), "left").where("head or template is not null")
    start = F.col("place") + F.col("lead") - F.col("at") + 1  # of the notice's first word, by the diagonal
    begin = F.greatest(F.lit(1), start - F.col("bound"))
    stop = start + F.size(F.split("notice", " ")) + F.col("bound")  # one word after the last
    hits = hits.withColumn("window", F.slice("words", begin, stop - begin + 1)).drop("words")
    hits = hits.withColumn("within", _within(F.col("window"), F.col("notice"), F.col("bound")))
    votes = hits.groupBy("row", "doc_id", "n_words", "template", "label", "is_base", "pairs",
                         (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count("at").alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"), F.max("within").alias("within"))
    line = Window.partitionBy("row", "template").orderBy("low", "diagonal")
    apart = ((F.abs(F.col("diagonal") - F.lag("diagonal").over(line)) > slack)
             | (F.col("low") - F.lag("high").over(line) > F.col("pairs")) | F.col("is_base"))
    merged = (votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("row", "doc_id", "n_words", "template", "label", "is_base", "pairs", "span")
              .agg(F.least(F.sum("votes"), F.first("pairs")).alias("votes"), F.min("low").alias("low"),
                   F.max("high").alias("high"), F.min("diagonal").alias("start"),
                   F.max("within").alias("within")))
    share = F.col("votes") / F.col("pairs")
    is_base = F.col("is_base") & (F.col("votes") == F.col("pairs"))
    accepted = is_base | F.col("within") | (~F.col("is_base") & (share >= covers)
                                            & (F.col("high") - F.col("low") + 2 <= longer * (F.col("pairs") + 1)))
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return merged.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        labels(is_base).alias("base_labels"), labels(accepted).alias("labels"),
        F.coalesce(F.max(F.when(accepted, share)), F.lit(0.0)).alias("score"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score")
