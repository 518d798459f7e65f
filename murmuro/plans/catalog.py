"""Every registered query: the operators bound to the driver's tables, whole tables each time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro import sample_tables as sample
from murmuro.functions import text, tokens
from murmuro.operators import (
    browse,
    chunking,
    classify,
    clean,
    entities,
    evaluate,
    keywords,
    language,
    lexical,
    lexicon,
    overview,
    relations,
    report,
    retrieval,
    spelling,
    tagging,
    topics,
)
from murmuro.operators.corpus_vectors import CorpusVectors
from murmuro.operators.term_index import TermIndex
from murmuro.operators.vector_index import VectorIndex
from murmuro.plans.enrich import enrich
from murmuro.runtime import fixed_table, n_rows, scalar, shared_folder, top, unnest, written
from murmuro.sources import bind, collector, files
from murmuro.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[run.__name__] = run
    return run


# Inputs shared by several queries


def valences(spark):
    return fixed_table(spark, sample.VALENCES, "word string, valence double")


def polarities(spark):
    return fixed_table(spark, sample.POLARITIES, "word string, polarity double, subjectivity double")


def emotion_words(spark):
    return fixed_table(spark, sample.EMOTION_WORDS, "word string, emotion string")


def gazetteer(spark):
    return fixed_table(spark, sample.GAZETTEER, "phrase string, label string, score double")


def domain_gazetteer(spark):
    return fixed_table(spark, sample.DOMAIN_GAZETTEER, "phrase string, label string, score double")


def aspects(spark):
    return fixed_table(spark, sample.ASPECTS, "term string")


def rated(spark, d, author=False):
    """Comments with sentiment by polarity, and topics."""
    df = lexicon.with_sentiment(bind.comments(spark, d, author), "polarity", polarities(spark))
    return bind.with_topics(df, bind.topics(spark, d))


def index(spark, d):
    """Stored vectors by document id."""
    return bind.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")


def topic_questions(spark, d):
    """(query_id, text, embedding): the first comment of each topic asks for that topic."""
    firsts = index(spark, d).groupBy("label").agg(F.min(F.struct("doc_id", "embedding")).alias("first"))
    chosen = firsts.select(F.col("label").alias("query_id"), "first.doc_id", "first.embedding")
    return chosen.join(bind.documents(spark, d).select("doc_id", "text"), "doc_id").select("query_id", "text", "embedding")


def benchmark_queries(spark, d):
    return bind.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def day(name="published_at"):
    return F.date_format(name, "yyyy-MM-dd")


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


# Sources and projections


@query
def comment_table(spark, d):
    df = bind.comments(spark, d, author=True)
    return df.select("doc_id", "video_id", "author", "likes", day().alias("published"), F.length("text").alias("n_chars"))


@query
def comment_documents(spark, d):
    docs = retrieval.comment_documents(rated(spark, d, author=True))
    return docs.select("doc_id", "text", "meta.*")


@query
def clean_comments(spark, d):
    df = clean.clean_comments(bind.documents(spark, d))
    return df.select("doc_id", "comment_id", "text", F.length("text_raw").alias("raw_chars"))


@query
def clean_pages(spark, d):
    pages = bind.table(spark, d, "pages")
    return pages.select("page_id", text.clean_text(F.col("html")).alias("text"))


@query
def token_text(spark, d):
    df = lexical.token_arrays(bind.documents(spark, d))
    return df.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("text"))


@query
def lemmatised_token_text(spark, d):
    """The whole chain, lemmas last."""
    df = lexical.lemma_arrays(bind.documents(spark, d), lemmas(spark, d))
    return df.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("text"))


@query
def normalised_text(spark, d):
    return bind.documents(spark, d).select("doc_id", text.normalise_for_tokens(F.col("text")).alias("text"))


@query
def text_measures(spark, d):
    t = F.col("text")
    return bind.documents(spark, d).select(
        "doc_id",
        text.word_count(t).alias("n_words"),
        text.sentence_count(t).alias("n_sentences"),
        text.syllable_count(t).alias("n_syllables"),
        F.length(t).alias("n_chars"),
        text.preview(t, 80).alias("preview"),
    )


@query
def stop_word_union(spark, d):
    english = fixed_table(spark, [(w,) for w in fixed.ENGLISH_STOP_WORDS], "word string")
    custom = fixed_table(spark, [(w,) for w in fixed.CUSTOM_STOP_WORDS], "word string")
    rows = unnest(bind.documents(spark, d), tokens.raw_tokens(F.col("text")), "token", "doc_id", pos="pos")
    kept = lexical.without_stop_words(rows.where(F.col("token").rlike("^[a-z]+$")), english, custom)
    return kept.groupBy("doc_id").agg(n_rows("n_tokens"))


@query
def attested_lemmas(spark, d):
    vocabulary = written(lexical.count_words(lexical.token_arrays(bind.documents(spark, d))), "vocabulary")
    return lexical.attested_lemmas(vocabulary)


@query
def distinct_texts(spark, d):
    return clean.first_by_text(bind.documents(spark, d)).select("doc_id", "video_id", "text")


@query
def stream_ingest(spark, d):
    import uuid

    folder = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}"
    source = f"{d}/documents.parquet"
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/documents*.parquet")
    ingest.ingest(stream, f"{folder}/out", f"{folder}/state", "doc_id").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("doc_id", "source", "lang", "text")


@query
def metadata_csv_round_trip(spark, d):
    import uuid

    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/comments.csv"
    df = bind.comments(spark, d, author=True).select(
        "video_id", "author", "text", "likes", F.col("published_at").cast("string").alias("published_at")
    )
    files.write_csv(df, path)
    back = files.read_comments_csv(spark, path).withColumn("published_at", text.parse_time(F.col("published_at")))
    return back.select("video_id", "author", "text", "likes", day().alias("published"))


def new_folder(spark, name):
    import uuid

    return f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/{name}"


@query
def loaded_comments(spark, d):
    """The cleaned CSV, which is loaded where there is no enriched table."""
    path = new_folder(spark, "comments.csv")
    df = bind.comments(spark, d, author=True).select(
        "video_id", "author", "text", "likes", F.col("published_at").cast("string").alias("published_at")
    )
    files.write_csv(df, path)
    back = files.load_comments(spark, new_folder(spark, "nothing"), path)
    return back.select("video_id", "author", "text", "likes", day().alias("published"))


def collector_pages(spark, d):
    """The documents as a collector would get them: per source one page for every hundred ids."""
    snippet = F.struct(
        F.col("lang").alias("authorDisplayName"),
        F.col("text").alias("textDisplay"),
        F.col("n_chars").cast("bigint").alias("likeCount"),
        F.col("source").alias("publishedAt"),
    )
    item = F.struct("doc_id", F.struct(F.struct(snippet.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    docs = bind.table(spark, d, "documents").select(F.col("source").alias("video_id"), F.floor(F.col("doc_id") / 100).alias("page_no"), item.alias("item"))
    pages = docs.groupBy("video_id", "page_no").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return pages.withColumn("items", F.transform("items", lambda x: F.struct(x["snippet"].alias("snippet"))))


@query
def flattened_pages(spark, d):
    return files.flatten_pages(written(collector_pages(spark, d), "pages"))


@query
def collected_comments(spark, d):
    """About 300 comments of the first three sources, to the end of a page, each text once."""
    pages = written(collector_pages(spark, d), "pages")
    sources = [r.video_id for r in pages.select("video_id").distinct().orderBy("video_id").limit(3).collect()]
    return files.collect_pages(pages, 300, sources)


@query
def replayed_pages(spark, d):
    """The same pages stored as a collector's answers, and followed from token to token up to 300 comments."""
    path = new_folder(spark, "answers")
    pages = written(collector_pages(spark, d), "pages")
    chain = Window.partitionBy("video_id").orderBy("page_no")
    name = lambda place: F.when(place == 0, collector.FIRST).otherwise(F.concat(F.lit("t"), place.cast("string")))
    place = F.row_number().over(chain) - 1
    following = F.when(F.lead("page_no").over(chain).isNotNull(), name(place + 1))
    answers = pages.select(
        F.col("video_id").alias("video"), name(place).alias("token"), F.to_json(F.struct("items", following.alias("nextPageToken"))).alias("value")
    )
    answers.write.partitionBy("video", "token").text(path)
    sources = [r.video_id for r in pages.select("video_id").distinct().orderBy("video_id").limit(3).collect()]
    collector.register(spark)
    return spark.read.format("comment_pages").option("path", path).option("videos", ",".join(sources)).option("target", 300).load()


@query
def metrics_log(spark, d):
    """The metrics of two runs, appended and read back."""
    path = new_folder(spark, "metrics")
    docs = bind.table(spark, d, "documents")
    for run, rows in (("all", docs), ("english", docs.where("lang = 'en'"))):
        found = rows.agg(n_rows("documents"), F.avg("n_chars").alias("mean_chars"))
        metrics = found.select(F.explode(F.create_map(F.lit("documents"), F.col("documents").cast("double"), F.lit("mean_chars"), F.col("mean_chars"))))
        files.write_metrics(metrics.toDF("key", "value"), path, run, {"lang": run})
    stored = spark.read.parquet(path)
    return rounded(stored.select("run_name", "key", "value", F.col("params")["lang"].alias("lang")), 6, "value")


@query
def built_stages(spark, d):
    """A stage that is there stays as it is unless it is to be rebuilt."""
    docs = bind.table(spark, d, "documents")
    first = lambda: docs.groupBy("lang").agg(n_rows("n"))
    second = lambda: docs.groupBy("lang").agg(F.sum("n_chars").alias("n"))
    kept, rebuilt = new_folder(spark, "kept"), new_folder(spark, "rebuilt")
    for path in (kept, rebuilt):
        files.build_stage(spark, path, first)
    out = files.build_stage(spark, kept, second).withColumn("stage", F.lit("kept"))
    return out.unionByName(files.build_stage(spark, rebuilt, second, rebuild=True).withColumn("stage", F.lit("rebuilt")))


# Browse and scope


@query
def browse_filtered(spark, d):
    df = browse.browse(
        rated(spark, d, author=True), "idiot|worthless|customer#0000001", ["positive", "negative"], 50, ("1993-01-01", "1998-01-01")
    )
    return browse.browse_view(df, "most liked").withColumn("published_at", day())


@query
def browse_longest(spark, d):
    df = bind.comments(spark, d)
    return top(df, 50, *browse.sort_order(df, "longest")).select("doc_id", F.length("text").alias("n_chars"), "likes")


@query
def browse_oldest(spark, d):
    df = bind.comments(spark, d)
    return top(df, 50, *browse.sort_order(df, "oldest")).select("doc_id", day().alias("published"))


@query
def browse_export(spark, d):
    """The browse view, oldest first, written as CSV and read back."""
    import uuid

    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/view.csv"
    df = browse.browse(rated(spark, d, author=True), "", ["negative"], 100)
    files.write_csv(browse.browse_view(df, "oldest").withColumn("published_at", day()), path)
    stored = "doc_id bigint, author string, sentiment string, likes bigint, published_at string"
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.select([F.col(c.split()[0]).cast(c.split()[1]) for c in stored.split(", ")])


@query
def enriched_round_trip(spark, d):
    """Rows with list columns through the enriched table, picked up by the loader ahead of a missing CSV."""
    import uuid

    folder = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}"
    df = entities.with_entities(bind.comments(spark, d), gazetteer(spark))
    files.write_enriched(df, f"{folder}/enriched")
    back = files.load_comments(spark, f"{folder}/enriched", f"{folder}/clean.csv")
    return back.select("doc_id", "likes", day().alias("published"), F.array_join("entities", "|").alias("entities"))


@query
def browse_newest(spark, d):
    df = bind.comments(spark, d)
    return top(df, 50, *browse.sort_order(df, "newest")).select("doc_id", day().alias("published"))


@query
def scope_first(spark, d):
    return browse.scope(bind.documents(spark, d), 500).select("doc_id", "text")


@query
def scope_most_liked(spark, d):
    return browse.scope(bind.comments(spark, d), 500, "most liked").select("doc_id", "likes")


@query
def scope_newest(spark, d):
    return browse.scope(bind.comments(spark, d), 500, "newest").select("doc_id", day().alias("published"))


@query
def scope_random(spark, d):
    return browse.scope(bind.documents(spark, d), 200, "random").select("doc_id", "text")


# Overview


@query
def overview_totals(spark, d):
    df = overview.totals(bind.comments(spark, d))
    df = rounded(df, 6, "avg_words", "question_share")
    return df.withColumns({"first_date": day("first_date"), "last_date": day("last_date")})


@query
def question_share(spark, d):
    return overview.question_share(bind.documents(spark, d))


@query
def questions(spark, d):
    return browse.questions(bind.documents(spark, d)).select("doc_id", "text")


@query
def sentiment_counts(spark, d):
    return overview.counts(rated(spark, d), "sentiment")


@query
def sentiment_percentages(spark, d):
    return overview.percentages(rated(spark, d))


@query
def sentiment_mood(spark, d):
    return rounded(overview.mood(rated(spark, d)), 6, "positive", "negative")


@query
def monthly_sentiment(spark, d):
    return overview.monthly(rated(spark, d))


@query
def length_histogram(spark, d):
    return rounded(overview.length_histogram(bind.documents(spark, d)), 6, "bin_start")


@query
def readability(spark, d):
    return rounded(overview.readability(bind.documents(spark, d)), 6, "reading_ease", "grade_level")


@query
def top_topics(spark, d):
    return overview.top_topics(bind.with_topics(bind.documents(spark, d), bind.topics(spark, d)), 10)


@query
def topic_sentiment(spark, d):
    return overview.topic_sentiment(rated(spark, d))


@query
def strongest_topic_sentiment(spark, d):
    return overview.strongest(overview.topic_sentiment(rated(spark, d)), "topic", "sentiment")


@query
def distinct_sentiments(spark, d):
    return overview.distinct_values(rated(spark, d), "sentiment")


@query
def distinct_languages(spark, d):
    return overview.distinct_count(bind.documents(spark, d), "lang")


@query
def subjective_share(spark, d):
    df = lexicon.with_polarity(bind.documents(spark, d), polarities(spark))
    return rounded(overview.subjective_share(df), 6, "subjective_percent")


@query
def first_comments_joined(spark, d):
    return overview.first_joined(bind.documents(spark, d), 20)


# Words and n-grams


@query
def word_frequencies(spark, d):
    return lexical.word_frequencies(bind.documents(spark, d))


@query
def lemma_frequencies(spark, d):
    docs = bind.documents(spark, d)
    vocabulary = written(lexical.count_words(lexical.token_arrays(docs)), "vocabulary")
    found = written(lexical.attested_lemmas(vocabulary), "lemmas")
    return top(lexical.lemmatised(vocabulary, found), 30, F.desc("count"), F.asc("token"))


def lemmas(spark, d):
    """(word, lemma) of the words whose shorter form the corpus uses too."""
    vocabulary = written(lexical.count_words(lexical.token_arrays(bind.documents(spark, d))), "vocabulary")
    return written(lexical.attested_lemmas(vocabulary), "lemmas")


@query
def lemma_cloud_weights(spark, d):
    return rounded(lexical.cloud_weights(bind.documents(spark, d), lemmas=lemmas(spark, d)), 6, "weight")


@query
def lemma_bigrams(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 2, lemmas=lemmas(spark, d))


@query
def lemma_trigrams(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 3, lemmas=lemmas(spark, d))


@query
def lemma_bigram_collocations(spark, d):
    return rounded(lexical.collocations(bind.documents(spark, d), 2, lemmas=lemmas(spark, d)), 6, "pmi")


@query
def lemma_trigram_collocations(spark, d):
    return rounded(lexical.collocations(bind.documents(spark, d), 3, lemmas=lemmas(spark, d)), 6, "pmi")


@query
def cloud_weights(spark, d):
    return rounded(lexical.cloud_weights(bind.documents(spark, d)), 6, "weight")


@query
def top_bigrams(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 2)


@query
def top_trigrams(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 3)


@query
def top_bigrams_spanning(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 2, span=True)


@query
def top_trigrams_spanning(spark, d):
    return lexical.top_ngrams(bind.documents(spark, d), 3, span=True)


@query
def bigram_collocations(spark, d):
    return rounded(lexical.collocations(bind.documents(spark, d), 2), 6, "pmi")


@query
def trigram_collocations(spark, d):
    return rounded(lexical.collocations(bind.documents(spark, d), 3), 6, "pmi")


@query
def bigram_collocations_spanning(spark, d):
    return rounded(lexical.collocations(bind.documents(spark, d), 2, span=True), 6, "pmi")


@query
def emoji_counts(spark, d):
    pages = bind.table(spark, d, "pages").select(text.decode_entities(F.col("html")).alias("text_raw"))
    return lexical.emoji_counts(pages)


@query
def distinctive_terms(spark, d):
    return rounded(lexical.distinctive_terms(bind.documents(spark, d), "lang"), 6, "score")


@query
def distinctive_terms_by_sentiment(spark, d):
    return rounded(lexical.distinctive_terms(rated(spark, d)), 6, "score")


# Lexicon scores


@query
def rule_sentiment(spark, d):
    df = lexicon.with_sentiment(bind.documents(spark, d), "rules", valences(spark))
    return df.select("doc_id", "sentiment", "sentiment_score")


@query
def polarity_sentiment(spark, d):
    df = lexicon.with_sentiment(bind.documents(spark, d), "polarity", polarities(spark))
    return df.select("doc_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"))


@query
def polarity_subjectivity(spark, d):
    df = lexicon.with_polarity(bind.documents(spark, d), polarities(spark))
    return rounded(df.select("doc_id", "polarity", "subjectivity"), 6, "polarity", "subjectivity")


@query
def emotion_totals(spark, d):
    return lexicon.emotion_totals(bind.documents(spark, d), emotion_words(spark))


@query
def leading_emotion(spark, d):
    return overview.strongest(lexicon.emotion_totals(bind.documents(spark, d), emotion_words(spark)), "emotion")


@query
def top_emotion_comments(spark, d):
    return lexicon.top_emotion_comments(bind.documents(spark, d), emotion_words(spark), "trust")


# Entities, aspects, keywords


@query
def named_entities(spark, d):
    df = entities.with_entities(bind.documents(spark, d), gazetteer(spark))
    return df.select(
        "doc_id",
        F.array_join("entities", "|").alias("entities"),
        F.array_join("entity_labels", "|").alias("entity_labels"),
    )


@query
def entity_counts(spark, d):
    return overview.list_counts(entities.with_entities(bind.documents(spark, d), gazetteer(spark)), "entities", 20)


@query
def domain_entities(spark, d):
    return entities.domain_entity_counts(bind.documents(spark, d), domain_gazetteer(spark))


@query
def domain_entities_chosen_labels(spark, d):
    labels = entities.parse_labels("platform, price, , character name")
    return entities.domain_entity_counts(bind.documents(spark, d), domain_gazetteer(spark), labels, 0.5)


@query
def leading_domain_entity(spark, d):
    return entities.leading_entity(entities.domain_entity_counts(bind.documents(spark, d), domain_gazetteer(spark)))


@query
def aspect_mentions(spark, d):
    return entities.aspect_mentions(bind.documents(spark, d), aspects(spark), valences(spark))


@query
def aspect_polarity_counts(spark, d):
    return entities.aspect_counts(entities.aspect_mentions(bind.documents(spark, d), aspects(spark), valences(spark)))


@query
def aspect_cloud_weights(spark, d):
    mentions = entities.aspect_mentions(bind.documents(spark, d), aspects(spark), valences(spark))
    return rounded(entities.aspect_cloud_weights(mentions), 6, "weight")


@query
def comment_keywords(spark, d):
    df = keywords.with_keywords(bind.documents(spark, d))
    return df.select("doc_id", F.array_join("keywords", "|").alias("keywords"))


@query
def single_text_keywords(spark, d):
    """Keywords that follow from each text alone."""
    df = keywords.with_single_keywords(bind.documents(spark, d))
    return df.select("doc_id", F.array_join("keywords", "|").alias("keywords"))


@query
def single_keyword_counts(spark, d):
    return overview.list_counts(keywords.with_single_keywords(bind.documents(spark, d)), "keywords", 20)


@query
def keyword_counts(spark, d):
    return overview.list_counts(keywords.keywords(bind.documents(spark, d)), "keywords", 20)


@query
def topic_labels(spark, d):
    docs = bind.with_topics(bind.documents(spark, d), bind.topics(spark, d))
    return overview.topic_labels(docs.join(keywords.keywords(bind.documents(spark, d)), "doc_id", "left"))


@query
def top_topics_labelled(spark, d):
    docs = bind.with_topics(bind.documents(spark, d), bind.topics(spark, d))
    labels = overview.topic_labels(docs.join(keywords.keywords(bind.documents(spark, d)), "doc_id", "left"))
    return overview.relabel(overview.top_topics(docs, 10), labels)


# Tags and relations


@query
def tag_distribution(spark, d):
    return tagging.tag_counts(bind.documents(spark, d))


@query
def pattern_tags(spark, d):
    words = unnest(bind.documents(spark, d), tokens.tag_tokens(F.col("text")), "word")
    return tagging.pattern_tags(words).groupBy("tag").agg(n_rows())


def training_tags(spark, d):
    """Tagged tokens of all sentences, a verb right after a determiner retagged as a noun."""
    return retagged_rows(tagging.sentence_rows(bind.documents(spark, d)))


def retagged_rows(sentences):
    tagged = tagging.tagged_sentences(sentences, "sent_id")
    before = F.concat(F.array(F.lit("")), F.col("tagged.tag"))
    pairs = F.arrays_zip("tagged", before.alias("before"))
    rows = unnest(tagged, pairs, "x", "sent_id", pos="pos")
    rows = rows.where(F.col("x.tagged").isNotNull())
    tag = F.when((F.col("x.before") == "DT") & F.col("x.tagged.tag").startswith("VB"), "NN").otherwise(F.col("x.tagged.tag"))
    return rows.select("sent_id", "pos", F.col("x.tagged.word").alias("word"), tag.alias("tag"))


def training_sentences(spark, d):
    """`training_tags` as sentences, made where their texts lie; only those that share an id are gathered by token."""
    alone, shared = tagging.sentences_by_id(tagging.sentence_rows(bind.documents(spark, d)))

    def retagged(x, i):
        noun = (F.get("tagged", i - 1)["tag"] == "DT") & x["tag"].startswith("VB")
        return F.struct(i.alias("pos"), x["word"].alias("word"), F.when(noun, "NN").otherwise(x["tag"]).alias("tag"))

    tagged = tagging.tagged_sentences(alone, "sent_id").where(F.size("tagged") > 0)
    arrays = tagged.select("sent_id", F.transform("tagged", retagged).alias("all"))
    return arrays.unionByName(tagging.sentence_arrays(retagged_rows(shared)))


@query
def unigram_tags(spark, d):
    model = tagging.train_ngram_taggers(written(training_tags(spark, d), "tagged"))
    return model.select("word", F.col("uni").alias("tag"))


@query
def ngram_tags(spark, d):
    tagged = written(training_sentences(spark, d), "tagged")
    model = written(tagging.train_ngram_taggers(tagged), "tagger")
    df = tagging.tag_with_ngrams(tagged, model)
    return df.groupBy("unigram", "bigram", "trigram").agg(n_rows("tokens"))


@query
def hmm_tags(spark, d):
    tagged = written(training_sentences(spark, d), "tagged")
    return tagging.tag_with_hmm(tagged, tagging.train_hmm(tagged)).groupBy("hmm").agg(n_rows("tokens"))


@query
def tagger_agreement(spark, d):
    tagged = written(training_sentences(spark, d), "tagged")
    return rounded(tagging.agreement(side_by_side(tagged), ["default", "unigram", "bigram", "trigram", "hmm"]), 6, "share")


def side_by_side(tagged):
    """Every token of the tagged sentences with the tags of all taggers, which are trained on them."""
    both = tagging.tag_with_hmm(tagged, tagging.train_hmm(tagged), by_token=False)
    both = tagging.tag_with_ngrams(both, written(tagging.train_ngram_taggers(tagged), "tagger"), by_token=False)
    return tagging.compare_in_sentences(both)


@query
def tagger_rows(spark, d):
    """Every token with the tags of all taggers side by side."""
    tagged = written(training_sentences(spark, d), "tagged")
    return side_by_side(tagged)


@query
def noun_chunks(spark, d):
    return relations.noun_chunks(relations.tagged_comments(bind.documents(spark, d)))


@query
def relation_triples(spark, d):
    return relations.relation_triples(relations.tagged_comments(bind.documents(spark, d)))


@query
def distinct_relations(spark, d):
    return relations.distinct_relations(relations.tagged_comments(bind.documents(spark, d)))


@query
def knowledge_graph_edges(spark, d):
    return relations.graph_edges(relations.relation_triples(relations.tagged_comments(bind.documents(spark, d))))


@query
def knowledge_graph_dot(spark, d):
    edges = relations.graph_edges(relations.relation_triples(relations.tagged_comments(bind.documents(spark, d))), 25)
    return relations.graph_dot(edges)


# Language, spelling


@query
def detected_languages(spark, d):
    docs = bind.documents(spark, d)
    return language.detect(docs, *language.train_profiles(docs))


@query
def language_distribution(spark, d):
    docs = bind.documents(spark, d)
    return language.distribution(language.detect(docs, *language.train_profiles(docs)))


def corpus_dictionary(spark, d, one_in=20_000):
    """(term, freq): the words that make at least one in `one_in` alphabetic words of the corpus.

    A share, not a count: in a larger corpus a common misspelling occurs more often, too.
    """
    words = unnest(bind.documents(spark, d), F.regexp_extract_all("text", F.lit(r"\S+"), 0), "term")
    counted = written(words.where(F.col("term").rlike(r"^\p{L}+$")).groupBy("term").agg(n_rows("freq")), "words")
    return counted.where(F.col("freq") * one_in >= scalar(counted.agg(F.sum("freq"))))


@query
def spelling_corrections(spark, d):
    words = unnest(bind.documents(spark, d), F.regexp_extract_all("text", F.lit(r"\S+"), 0), "word")
    dictionary = written(corpus_dictionary(spark, d), "dictionary")
    return spelling.corrections(words.where(F.col("word").rlike(r"^\p{L}+$")), dictionary)


@query
def corrected_text(spark, d):
    dictionary = written(corpus_dictionary(spark, d), "dictionary")
    return spelling.correct_text(bind.documents(spark, d), dictionary)


# Topics and classification


@query
def topic_table(spark, d):
    docs = bind.documents(spark, d).join(bind.topics(spark, d), "doc_id")
    return topics.topic_table(docs)


@query
def topic_words(spark, d):
    docs = bind.documents(spark, d).join(bind.topics(spark, d), "doc_id")
    return topics.topic_words(docs)


@query
def clustered_topics(spark, d):
    """Topics of all comments, from their texts alone."""
    return topics.with_topics(bind.documents(spark, d)).select("doc_id", "topic")


@query
def topic_cover(spark, d):
    """What the numbers of any topics must keep to, in a form that SQL can say too."""
    sizes = written(clustered_topics(spark, d), "topics").groupBy("topic").agg(n_rows("n"))
    before = F.lag("n").over(Window.orderBy("topic"))
    # One row per topic.
    inside = sizes.where("topic >= 0").withColumn("fits", (F.col("n") <= F.coalesce(before, "n")) & (F.col("n") >= fixed.MIN_TOPIC_SIZE))
    return sizes.agg(F.sum("n").alias("documents"), F.min("topic").alias("least")).join(
        inside.agg(F.coalesce(F.every("fits"), F.lit(True)).alias("by_size")), how="cross"
    ).select("documents", (F.col("least") >= -1).alias("numbered"), "by_size")


@query
def large_sentiment_groups(spark, d):
    df = rated(spark, d)
    return overview.counts(topics.in_large_groups(df), "sentiment")


@query
def topics_per_sentiment(spark, d):
    return topics.topics_per_sentiment(rated(spark, d).drop("topic"), min_size=10)


def labelled(spark, d):
    labels = bind.table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return bind.documents(spark, d).join(labels, "doc_id").select("doc_id", "text", "label")


@query
def stratified_split(spark, d):
    return classify.stratified_split(labelled(spark, d)).select("doc_id", "label", "part")


@query
def classifier_report(spark, d):
    return rounded(classify.train(labelled(spark, d), iterations=100)[1], 6, "precision", "recall", "f1")


@query
def tuned_classifier_report(spark, d):
    report_ = classify.train(labelled(spark, d), tune=True, iterations=20)[1]
    return rounded(report_, 6, "precision", "recall", "f1")


@query
def model_sentiment(spark, d):
    model, _ = classify.train(labelled(spark, d), iterations=50)
    df = lexicon.with_sentiment(bind.documents(spark, d), "model", model=model)
    return df.groupBy("sentiment").agg(n_rows(), F.round(F.avg("sentiment_score"), 3).alias("score"))


@query
def toxicity_rule_report(spark, d):
    labels = bind.table(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"))
    rated_ = lexicon.with_sentiment(bind.documents(spark, d), "polarity", polarities(spark))
    judged = rated_.join(labels, "doc_id").withColumn("prediction", (F.col("sentiment") == "negative").cast("int"))
    return rounded(evaluate.classification_report(judged), 6, "precision", "recall", "f1")


# Retrieval


@query
def semantic_search(spark, d):
    return rounded(retrieval.semantic(topic_questions(spark, d), index(spark, d)), 6, "distance")


@query
def filtered_search(spark, d):
    df = lexicon.with_sentiment(bind.documents(spark, d), "polarity", polarities(spark))
    stored = index(spark, d).join(df.select("doc_id", "sentiment"), "doc_id")
    hits = report.negative_examples(topic_questions(spark, d), stored, bind.documents(spark, d))
    return rounded(hits.select("query_id", "rank", "doc_id", "distance"), 6, "distance")


@query
def indexed_search(spark, d):
    import uuid

    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/index"
    docs = bind.documents(spark, d).select("doc_id", "lang")
    files.write_index(docs, index(spark, d), path)
    stored = files.open_index(spark, path)
    return rounded(retrieval.filtered(topic_questions(spark, d), stored, {"lang": "en"}), 6, "distance")


def vector_index(spark, d, *parts):
    """An inverted-file index of the stored vectors, or of the first part with the others appended."""
    import uuid

    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/vectors"
    first, *more = parts or [index(spark, d)]
    built = VectorIndex.build(first, path)
    for rows in more:
        built.append(rows)
    return VectorIndex(spark, path)


@query
def index_search(spark, d):
    """Nearest rows by the index, gone on with until no cell can hold a nearer one."""
    hits = vector_index(spark, d).search(topic_questions(spark, d), exact=True)
    return rounded(hits, 6, "distance")


@query
def appended_index_search(spark, d):
    """The same over an index of which half the rows were added later."""
    rows = index(spark, d)
    built = vector_index(spark, d, rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1"))
    return rounded(built.search(topic_questions(spark, d), exact=True), 6, "distance")


def approximate_figures(spark, d):
    asked = written(topic_questions(spark, d).select("query_id", "embedding"), "questions")
    built = vector_index(spark, d)
    chosen = written(built.shortlist(asked), "shortlist")
    found = retrieval.recall(built.scored(asked, chosen, fixed.TOP_K), retrieval.semantic(asked, index(spark, d)))
    return found.join(built.effort(asked, chosen), how="cross")


@query
def approximate_search_recall(spark, d):
    """(truth, recall, codes_share, vectors_share): the search by a measured number of cells against the exact one."""
    return rounded(approximate_figures(spark, d), 6, "recall", "codes_share", "vectors_share")


@query
def approximate_search_bounds(spark, d):
    """What those figures must keep to, in a form that SQL can say too."""
    figures = approximate_figures(spark, d)
    return figures.select("truth", (F.col("recall") >= 0.95).alias("found_enough"), (F.col("vectors_share") < 0.1).alias("read_little"))


@query
def diverse_search(spark, d):
    return retrieval.diverse(topic_questions(spark, d), index(spark, d))


@query
def lexical_search(spark, d):
    return rounded(retrieval.lexical(benchmark_queries(spark, d), bind.documents(spark, d)), 4, "score")


def term_index(spark, d, *parts):
    """An inverted index of all comments, or of the first part with the others appended."""
    import uuid

    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/terms"
    first, *more = parts or [bind.documents(spark, d)]
    built = TermIndex.build(first, path)
    for rows in more:
        built.append(rows)
    return TermIndex(spark, path)


@query
def term_index_search(spark, d):
    return rounded(term_index(spark, d).search(benchmark_queries(spark, d)), 4, "score")


@query
def appended_term_index_search(spark, d):
    """The same over an index to which half the comments were added later."""
    docs = bind.documents(spark, d)
    built = term_index(spark, d, docs.where("doc_id % 2 = 1"), docs.where("doc_id % 2 = 0"))
    return rounded(built.search(benchmark_queries(spark, d)), 4, "score")


@query
def term_index_effort(spark, d):
    """(query_id, blocks, scored): blocks of documents that hold a query's terms, and those that had to be scored."""
    return term_index(spark, d).effort(benchmark_queries(spark, d))


@query
def hybrid_search(spark, d):
    docs = bind.documents(spark, d)
    hits = retrieval.hybrid(written(topic_questions(spark, d), "questions"), index(spark, d), docs)
    return rounded(hits.select("query_id", "rank", "doc_id", "score"), 6, "score")


def centroids(spark, d):
    """(query_id, embedding): the mean vector of each topic."""
    rows = unnest(index(spark, d), "embedding", "x", "label", pos="i")
    means = rows.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"])
    return means.groupBy("label").agg(ordered.alias("embedding")).select(F.col("label").alias("query_id"), "embedding")


@query
def reranked_search(spark, d):
    asked = written(topic_questions(spark, d), "questions")
    middle = written(centroids(spark, d), "centroids")
    hits = written(retrieval.semantic(asked, index(spark, d), 10), "hits")
    scores = retrieval.cosine_scores(hits, middle, index(spark, d))
    return retrieval.reranked(hits, scores, 5).select("query_id", "rank", "doc_id", "score")


@query
def rank_shift(spark, d):
    asked = written(topic_questions(spark, d), "questions")
    middle = written(centroids(spark, d), "centroids")
    hits = written(retrieval.semantic(asked, index(spark, d), 10), "hits")
    scores = retrieval.cosine_scores(hits, middle, index(spark, d))
    return retrieval.rank_shift(hits, retrieval.reranked(hits, scores, 5))


def expansions(spark, d):
    """(query_id, no, embedding): the first comment and the centroid of each topic."""
    first = topic_questions(spark, d).select("query_id", F.lit(1).alias("no"), F.col("embedding").cast("array<double>"))
    return first.unionByName(centroids(spark, d).select("query_id", F.lit(2).alias("no"), "embedding"))


@query
def expanded_search(spark, d):
    asked = written(topic_questions(spark, d), "questions")
    more = written(expansions(spark, d), "expansions")
    hits = retrieval.expanded(asked, more, index(spark, d), bind.documents(spark, d))
    return hits.select("query_id", "rank", "doc_id", "score")


@query
def strategy_overlap(spark, d):
    asked, docs, stored = written(topic_questions(spark, d), "questions"), bind.documents(spark, d), index(spark, d)
    compared = retrieval.side_by_side(
        {
            "semantic": retrieval.semantic(asked, stored, 4),
            "lexical": retrieval.lexical(asked, docs, 4),
            "hybrid": retrieval.hybrid(asked, stored, docs, 4),
            "diverse": retrieval.diverse(asked, stored, 4),
        }
    )
    return retrieval.overlap(compared)


@query
def strategy_rows(spark, d):
    """The hits of three strategies side by side."""
    asked, docs, stored = written(topic_questions(spark, d), "questions"), bind.documents(spark, d), index(spark, d)
    return retrieval.side_by_side(
        {
            "semantic": retrieval.semantic(asked, stored, 4),
            "lexical": retrieval.lexical(asked, docs, 4),
            "diverse": retrieval.diverse(asked, stored, 4),
        }
    )


@query
def retrieval_quality_per_question(spark, d):
    """Every question has expected words of its own: its first three long ones."""
    asked, docs = written(topic_questions(spark, d), "questions"), bind.documents(spark, d)
    hits = retrieval.with_columns_of(retrieval.semantic(asked, index(spark, d)), docs, "text")
    long = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0), lambda w: F.length(w) >= 8)
    expect = asked.select("query_id", F.slice(long, 1, 3).alias("expect"))
    return rounded(evaluate.retrieval_metrics(hits, expect), 6, "hit_rate", "mrr")


@query
def retrieval_quality(spark, d):
    asked, docs = written(topic_questions(spark, d), "questions"), bind.documents(spark, d)
    hits = retrieval.with_columns_of(retrieval.semantic(asked, index(spark, d)), docs, "text")
    expect = F.array(*[F.lit(w) for w in sample.EXPECTED_WORDS])
    return rounded(evaluate.retrieval_metrics(hits, asked.select("query_id", expect.alias("expect"))), 6, "hit_rate", "mrr")


@query
def answer_quality(spark, d):
    answers = bind.table(spark, d, "conversations").where("role = 'assistant'")
    return rounded(evaluate.answer_metrics(answers), 6, "avg_answer_words", "groundedness")


# Chunks


@query
def recursive_chunks(spark, d):
    return chunking.chunk(bind.documents(spark, d), "recursive")


@query
def token_chunks(spark, d):
    return chunking.chunk(bind.documents(spark, d), "token")


@query
def semantic_chunks(spark, d):
    return chunking.chunk(bind.documents(spark, d), "semantic")


@query
def semantic_vector_chunks(spark, d):
    docs = bind.documents(spark, d)
    return chunking.semantic_vector_chunks(docs, CorpusVectors.fit(docs))


@query
def rejoined_vector_chunks(spark, d):
    """The chunks of each text in order, put together again: nothing is lost or moved."""
    chunks = semantic_vector_chunks(spark, d)
    ordered = F.sort_array(F.collect_list(F.struct("chunk_no", "chunk")))
    return chunks.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["chunk"]), " ").alias("text"))


# Reports


@query
def sentiment_insight(spark, d):
    return report.sentiment_insight(rated(spark, d))


@query
def topic_insight(spark, d):
    return report.topic_insight(rated(spark, d))


@query
def full_report(spark, d):
    df = rated(spark, d)
    # Keywords read the comments several times; they are joined and rated once.
    df = written(entities.with_entities(df, gazetteer(spark)), "rated")
    return report.full_report(written(keywords.with_keywords(df), "enriched"))


@query
def summary_context(spark, d):
    return report.summary_context(topic_questions(spark, d), index(spark, d), rated(spark, d))


@query
def routed_queries(spark, d):
    turns = bind.table(spark, d, "conversations").where("role = 'user'")
    return report.routed(turns, sample.ROUTE_CATEGORIES).select("conv_id", "turn", "category", "specialist")


@query
def routed_query_counts(spark, d):
    turns = bind.table(spark, d, "conversations").where("role = 'user'")
    return overview.counts(report.routed(turns, sample.ROUTE_CATEGORIES), "category")


def enriched(spark, d, topics):
    df = enrich(bind.comments(spark, d, author=True), gazetteer(spark), valences(spark), topics=topics)
    joined = {n: F.array_join(n, "|") for n in ("entities", "keywords")}
    return df.withColumns(joined)


@query
def enriched_fields(spark, d):
    """The enrichment without topics, whose numbers plain SQL cannot reproduce."""
    df = enriched(spark, d, False)
    return df.select("comment_id", "doc_id", "sentiment", "sentiment_score", "entities", "keywords")


@query
def enriched_comments(spark, d):
    df = enriched(spark, d, True)
    return df.select("comment_id", "doc_id", "sentiment", "sentiment_score", "topic", "entities", "keywords")
