"""The registered queries stated a second time, as SQL for DuckDB."""

from __future__ import annotations

from storytide.checks import fixtures as fx
from storytide.functions.stopwords import ENGLISH
from storytide.schema import AVERAGES, EMOTIONS, RATIOS

LIKED = "'7'"
TEST_BOOKS = ", ".join(f"'{i}'" for i in range(15))
AVG_E = [f"avg_{e}" for e in EMOTIONS]
AVG_D = ["avg_valence", "avg_arousal", "avg_dominance"]


# Results are compared after rounding to 6 digits, scores are ranked at 9. The small
# offsets move values that lie exactly on a rounding boundary off it.


def r(expression: str, name: str | None = None) -> str:
    return f"round({expression} + 1e-10, 6) AS {name or expression}"


def rs(names) -> str:
    return ", ".join(r(n) for n in names)


def in_turn(values: tuple, key: str) -> str:
    listed = ", ".join(fx.text_literal(v) for v in values)
    return f"([{listed}])[{key} % {len(values)} + 1]"


def list_of(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


# ---- common table expressions ---------------------------------------------------

LEXICONS = f"""
emo(word, emotion, value) AS (VALUES {fx.emotion_values()}),
vad(term, v, a, d) AS (VALUES {fx.vad_values()}),
stop(w) AS (VALUES {", ".join("(" + fx.text_literal(w) + ")" for w in ENGLISH)})"""

BOOKS = f"""
books AS (
  SELECT CAST(doc_id AS VARCHAR) AS book_id, 'Document ' || doc_id AS title, source AS author,
         lang AS language, {in_turn(fx.BOOKSHELVES, "doc_id")} AS bookshelves,
         {in_turn(fx.SUBJECTS, "doc_id")} AS subjects, text
  FROM documents)"""


def chunk_ctes(books: str, pieces: str = "20", prefix: str = "") -> str:
    return f"""
{prefix}sized AS (
  SELECT *, greatest(1, length(text) // pieces) AS step, length(text) AS chars
  FROM (SELECT *, {pieces} AS pieces FROM {books} WHERE length(text) > 0) s),
{prefix}chunks AS (
  SELECT book_id, title, author, CAST(i AS INTEGER) AS chunk_index,
         CASE WHEN i = pieces - 1 THEN substring(text, i * step + 1)
              ELSE substring(text, i * step + 1, step) END AS chunk_text
  FROM {prefix}sized, range(20) t(i) WHERE i < pieces AND i * step < chars)"""


def word_ctes(chunks: str, prefix: str = "") -> str:
    clean = "regexp_replace(lower(chunk_text), '[^a-z0-9\\s'']', ' ', 'g')"
    for pattern, new in (
        ("''s\\b", ""), ("n''t\\b", " not"), ("''re\\b", " are"), ("''ve\\b", " have"),
        ("''ll\\b", " will"), ("''d\\b", " would"), ("''", ""),
    ):
        clean = f"regexp_replace({clean}, '{pattern}', '{new}', 'g')"
    return f"""
{prefix}split AS (
  SELECT * EXCLUDE (chunk_text), list_filter(regexp_split_to_array({clean}, '\\s+'),
           lambda w: length(w) > 2 AND w NOT IN (SELECT stop.w FROM stop)) AS words
  FROM {chunks})"""


# DuckDB has no subquery inside a lambda, so the stop words go in as a list.
def word_ctes_listed(chunks: str, prefix: str = "") -> str:
    stops = "[" + ", ".join(fx.text_literal(w) for w in ENGLISH) + "]"
    return word_ctes(chunks, prefix).replace("w NOT IN (SELECT stop.w FROM stop)", f"NOT list_contains({stops}, w)")


def score_ctes(split: str, prefix: str = "") -> str:
    counts = ", ".join(f"CAST(count(*) FILTER (emotion = '{e}') AS INTEGER) AS {e}" for e in EMOTIONS)
    zero = ", ".join(f"coalesce({e}, 0) AS {e}" for e in EMOTIONS)
    return f"""
{prefix}tokens AS (SELECT * EXCLUDE (words), unnest(words) AS w FROM {split}),
{prefix}felt AS (
  SELECT book_id, chunk_index, {counts} FROM {prefix}tokens JOIN emo ON emo.word = w GROUP BY ALL),
{prefix}placed AS (
  SELECT book_id, chunk_index, avg(v) AS avg_valence, avg(a) AS avg_arousal, avg(d) AS avg_dominance,
         CAST(count(*) AS INTEGER) AS vad_word_count
  FROM {prefix}tokens JOIN vad ON term = w GROUP BY book_id, chunk_index),
{prefix}scores AS (
  SELECT s.book_id, title, author, s.chunk_index, {zero},
         coalesce(avg_valence, 0e0) AS avg_valence, coalesce(avg_arousal, 0e0) AS avg_arousal,
         coalesce(avg_dominance, 0e0) AS avg_dominance, coalesce(vad_word_count, 0) AS vad_word_count
  FROM {split} s LEFT JOIN {prefix}felt f ON f.book_id = s.book_id AND f.chunk_index = s.chunk_index
  LEFT JOIN {prefix}placed p ON p.book_id = s.book_id AND p.chunk_index = s.chunk_index)"""


def trajectory_ctes(scores: str, prefix: str = "") -> str:
    total = " + ".join(EMOTIONS)
    norms = ", ".join(
        f"CASE WHEN {total} > 0 THEN CAST({e} AS DOUBLE) / ({total}) ELSE 0.125e0 END AS {e}_norm" for e in EMOTIONS
    )
    means = ", ".join([f"avg({e}) AS avg_{e}" for e in EMOTIONS] + [f"avg({c}) AS {c}" for c in AVG_D])
    book_total = " + ".join(AVG_E)
    ratios = ", ".join(
        f"CASE WHEN {book_total} > 0 THEN avg_{e} / ({book_total}) ELSE 0.125e0 END AS ratio_{e}" for e in EMOTIONS
    )
    point = ", ".join(["CAST(chunk_index AS DOUBLE)"] + [f"{e}_norm" for e in EMOTIONS])
    return f"""
{prefix}normal AS (SELECT *, {norms} FROM {scores}),
{prefix}means AS (
  SELECT book_id, title, author, {means}, count(*) AS num_chunks,
         list([{point}] ORDER BY chunk_index) AS emotion_trajectory
  FROM {prefix}normal GROUP BY book_id, title, author),
{prefix}plain AS (SELECT *, {ratios} FROM {prefix}means)"""


VECTORS = """
vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS vec_book, CAST(embedding AS DOUBLE[]) AS book_embedding,
         list_transform(CAST(embedding AS DOUBLE[]),
           lambda x: abs(x) / list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: abs(y)))) AS book_topics
  FROM embeddings),
traj AS MATERIALIZED (
  SELECT plain.*, book_embedding, book_topics FROM plain LEFT JOIN vectors ON vec_book = book_id)"""

SCORES = ",".join([LEXICONS, BOOKS, chunk_ctes("books"), word_ctes_listed("chunks"), score_ctes("split")])
TRAJ = ",".join([SCORES, trajectory_ctes("scores"), VECTORS])

ADHOC_BOOKS = """
adhoc AS (
  SELECT 'text_file_' || item_id AS book_id, 'item ' || item_id AS title, 'File Input' AS author, text
  FROM benchmark)"""
ADAPTIVE = "CASE WHEN length(text) < 10000 THEN greatest(5, least(10, length(text) // 1000)) ELSE 20 END"
ADHOC = ",".join(
    [
        ADHOC_BOOKS,
        chunk_ctes("adhoc", ADAPTIVE, "q_"),
        word_ctes_listed("q_chunks", "q_"),
        score_ctes("q_split", "q_"),
        trajectory_ctes("q_scores", "q_"),
    ]
)


def cos(a: str, b: str) -> str:
    norms = f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    return f"CASE WHEN {norms} > 0 THEN list_dot_product({a}, {b}) / {norms} ELSE 0e0 END"


def padded(a: str, b: str) -> str:
    return f"list_resize({a}, greatest(length({a}), length({b})), 0e0)"


def shape(arc: str) -> str:
    return f"flatten(list_transform({arc}, lambda p: p[2:9]))"


WEIGHTS = {
    "ratio_anger": 1.5, "ratio_anticipation": 2.0, "ratio_disgust": 1.5, "ratio_fear": 3.0, "ratio_joy": 3.0,
    "ratio_sadness": 2.0, "ratio_surprise": 1.5, "ratio_trust": 0.5,
    "avg_valence": 4.0, "avg_arousal": 4.0, "avg_dominance": 4.0,
}


def signals(arc=lambda column: f"flatten({column})") -> dict[str, str]:
    squares = " + ".join(f"pow((b.{c} - q.{c}) * {w}e0, 2)" for c, w in WEIGHTS.items())
    one, two = arc("b.emotion_trajectory"), arc("q.emotion_trajectory")
    return {
        "feature": f"1e0 / (1e0 + sqrt({squares}))",
        "trajectory": cos(padded(one, two), padded(two, one)),
        "embedding": "CASE WHEN b.book_embedding IS NULL OR q.book_embedding IS NULL THEN 0e0 ELSE "
        f"({cos('b.book_embedding', 'q.book_embedding')} + 1e0) / 2e0 END",
        "topic": "CASE WHEN b.book_topics IS NULL OR q.book_topics IS NULL THEN 0e0 ELSE "
        f"{cos('b.book_topics', 'q.book_topics')} END",
    }


def pair_cte(ids: str, corpus: str = "traj", arc=lambda column: f"flatten({column})") -> str:
    listed = ", ".join(f"{sql} AS s_{name}" for name, sql in signals(arc).items())
    return f"""
pairs AS MATERIALIZED (
  SELECT q.book_id AS query_id, b.*, {listed}
  FROM {corpus} b JOIN {corpus} q ON b.book_id <> q.book_id AND q.book_id IN ({ids}))"""


SHELF = "list_filter(list_transform(string_split(lower(coalesce(bookshelves, '')), ';'), lambda s: trim(s)), lambda s: s <> '' AND s <> 'browsing: fiction')"
SUBJECT = """list_filter(list_transform(list_transform(string_split(lower(coalesce(subjects, '')), ';'), lambda s: trim(s)),
  lambda s: CASE WHEN contains(s, 'fiction') AND s <> 'fiction' THEN s WHEN contains(s, 'horror') THEN 'horror'
    WHEN contains(s, 'science fiction') THEN 'science fiction' WHEN contains(s, 'fantasy') THEN 'fantasy'
    WHEN contains(s, 'romance') THEN 'romance' WHEN contains(s, 'mystery') OR contains(s, 'detective') THEN 'mystery'
    WHEN contains(s, 'adventure') THEN 'adventure'
    WHEN contains(s, 'children') OR contains(s, 'juvenile') THEN 'children''s literature'
    WHEN contains(s, 'historical') THEN 'historical fiction' END), lambda s: s IS NOT NULL)"""
TAGS = f"""
tagged AS (SELECT book_id, list_sort(list_distinct(list_concat({SHELF}, {SUBJECT}))) AS tags FROM books)"""


def genre_cte(ids: str) -> str:
    return f"""{TAGS},
genres AS (
  SELECT q.book_id AS query_id, b.book_id,
         CAST(length(list_intersect(b.tags, q.tags)) AS DOUBLE)
           / length(list_distinct(list_concat(b.tags, q.tags))) AS s_genre
  FROM tagged b JOIN tagged q ON b.book_id <> q.book_id AND q.book_id IN ({ids}) AND length(q.tags) > 0)"""


PRESETS = {
    "similar_experience": (0.3, 0.35, 0.15, 0.1, 0.1),
    "similar_themes": (0.2, 0.1, 0.25, 0.35, 0.1),
    "similar_style": (0.2, 0.15, 0.4, 0.15, 0.1),
    "genre_focused": (0.25, 0.15, 0.1, 0.1, 0.4),
    "balanced": (0.3, 0.2, 0.15, 0.15, 0.2),
}


def blend(preset: str, genre: bool = True) -> str:
    f, t, e, o, g = PRESETS[preset]
    tail = f" + {g}e0 * coalesce(s_genre, 0e0)" if genre else ""
    return f"({f}e0 * s_feature + {t}e0 * s_trajectory + {e}e0 * s_embedding + {o}e0 * s_topic{tail})"


def joined_pairs(ids: str, corpus: str = "traj") -> str:
    """Pairs with the genre signal, and the balanced blend as ``similarity``."""
    return f"""{pair_cte(ids, corpus)}, {genre_cte(ids)},
scored AS (
  SELECT pairs.*, s_genre, {blend("balanced")} AS similarity
  FROM pairs LEFT JOIN genres ON genres.query_id = pairs.query_id AND genres.book_id = pairs.book_id)"""


HITS = f"""{TRAJ}, {joined_pairs(TEST_BOOKS)},
hits AS MATERIALIZED (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY round(similarity + 1e-12, 9) DESC, book_id) AS INTEGER) AS rank FROM scored) ranked
  WHERE rank <= 10)"""


def top(score: str, n: int) -> str:
    return f"ORDER BY round({score} + 1e-12, 9) DESC, book_id LIMIT {n}"


CATALOGUE = "book_id, title, author, language, bookshelves, subjects"
MD5_WORDS = "CAST(length(words) AS INTEGER) AS n_words, md5(array_to_string(words, ' ')) AS words_md5"
NORMS = [f"{e}_norm" for e in EMOTIONS]
LABELLED = "SELECT CAST(doc_id AS VARCHAR) FROM labels"


def oracle() -> dict[str, str]:
    sql: dict[str, str] = {}
    words = ",".join([LEXICONS, BOOKS, chunk_ctes("books"), word_ctes_listed("chunks")])
    distinct_words = f"{words}, vocabulary AS (SELECT DISTINCT unnest(words) AS w FROM split)"

    # sources
    sql["emotion_lexicon_load"] = f"""WITH {distinct_words}
      SELECT w AS word, ({list_of(EMOTIONS)})[ascii(w) % 8 + 1] AS emotion, 1 AS value
      FROM vocabulary WHERE length(w) % 4 = 0
      UNION ALL SELECT w, 'positive', 1 FROM vocabulary WHERE ascii(w) % 2 = 0"""
    number = "(((ascii(w) + length(w)) * {}) % 200 - 100) / 100e0"
    sql["vad_lexicon_load"] = f"""WITH {distinct_words}
      SELECT w AS term, {number.format(37)} AS valence, {number.format(53)} AS arousal, {number.format(71)} AS dominance
      FROM vocabulary WHERE length(w) % 4 <> 3 AND length(w) % 5 <> 0 AND w <> 'term'"""
    # A CSV reader takes an empty field for a missing one.
    sql["metadata_filter"] = f"""WITH {BOOKS} SELECT {CATALOGUE.replace("bookshelves", "nullif(bookshelves, '') AS bookshelves")}
      FROM books WHERE language = 'en'"""
    sql["lookup_book"] = f"WITH {BOOKS} SELECT book_id, title, author FROM books WHERE book_id = {LIKED}"
    sql["books_join_metadata"] = (
        f"WITH {BOOKS} SELECT book_id, title, author, CAST(length(text) AS INTEGER) AS n_chars FROM books WHERE language = 'en'"
    )
    kept = f"WITH {BOOKS} SELECT book_id, title, CAST(length(text) AS INTEGER) AS n_chars FROM books WHERE book_id"
    sql["catalogue_trajectories"] = f"""WITH {TRAJ} SELECT book_id, 'The ' || title AS title, author, num_chunks, {rs(AVERAGES)}
      FROM plain WHERE book_id IN (SELECT book_id FROM books WHERE language = 'en')"""
    sql["semi_join_targets"] = f"{kept} IN ({LABELLED})"
    sql["resume_anti_join"] = f"{kept} NOT IN ({LABELLED})"
    sql["training_sample"] = f"""WITH {BOOKS} SELECT book_id FROM books
      ORDER BY md5('42:' || book_id), book_id LIMIT 200"""
    sql["assign_batches"] = f"""WITH {BOOKS} SELECT book_id,
      CAST(CAST('0x' || substring(md5('42:' || book_id), 1, 8) AS BIGINT) % 10 AS INTEGER) AS batch FROM books"""
    with_end = "filed AS (SELECT book_id, title, author, text || chr(10) AS text FROM books WHERE language = 'en')"
    sql["books_from_files"] = f"""WITH {LEXICONS}, {BOOKS}, {with_end}, {chunk_ctes("filed")},
      {word_ctes_listed("chunks")}
      SELECT book_id, title, author, chunk_index, {MD5_WORDS} FROM split"""
    sql["trajectory_roundtrip"] = f"""WITH {TRAJ} SELECT book_id, num_chunks, {rs(AVERAGES)},
      CAST(length(emotion_trajectory) AS INTEGER) AS points, CAST(coalesce(length(book_embedding), 0) AS INTEGER) AS dimensions FROM traj"""
    sql["csv_roundtrip"] = f"""WITH {TRAJ}, {joined_pairs(LIKED)}
      SELECT book_id, title, author, {rs(AVERAGES)},
        {r("list_sum(flatten(emotion_trajectory))", "arc_sum")}, {r("emotion_trajectory[-1][9]", "last_trust")}
        FROM scored {top("similarity", 10)}"""

    # text
    sql["strip_markers"] = f"""WITH {BOOKS} SELECT book_id, CAST(length(body) AS INTEGER) AS n_chars, md5(body) AS body_md5
      FROM (SELECT book_id, regexp_replace(regexp_replace(
        'head *** START OF ' || title || chr(10) || 'ONE ***' || text || '*** END OF' || chr(10) || title || ' *** tail',
        '\\*\\*\\* START.*?\\*\\*\\*', '', 'gs'), '\\*\\*\\* END.*?\\*\\*\\*', '', 'gs') AS body FROM books)"""
    sql["chunk_text"] = f"""WITH {BOOKS}, {chunk_ctes("books")}
      SELECT book_id, chunk_index, CAST(length(chunk_text) AS INTEGER) AS n_chars, md5(chunk_text) AS chunk_md5 FROM chunks"""
    sql["tokenize_words"] = f"WITH {words} SELECT book_id, chunk_index, {MD5_WORDS} FROM split"
    sql["adaptive_chunks"] = f"""WITH {BOOKS} SELECT book_id, least({ADAPTIVE}, length(text)) AS chunks,
      length(text) AS n_chars FROM books WHERE length(text) > 0"""
    sql["genre_tags"] = f"WITH {BOOKS}, {TAGS} SELECT book_id, array_to_string(tags, '|') AS tags FROM tagged"

    # scoring
    key = "book_id, title, author, chunk_index"
    emotions = ", ".join(EMOTIONS)
    sql["score_emotions"] = f"WITH {SCORES} SELECT {key}, {emotions} FROM scores"
    sql["score_vad"] = f"WITH {SCORES} SELECT {key}, {rs(AVG_D)}, vad_word_count FROM scores"
    sql["score_chunks"] = f"WITH {SCORES} SELECT {key}, {emotions}, {rs(AVG_D)}, vad_word_count FROM scores"
    turns = """turns AS (SELECT CAST(conv_id AS VARCHAR) AS book_id, 'Conversation ' || conv_id AS title,
      'dialogue' AS author, CAST(turn AS INTEGER) AS chunk_index, text AS chunk_text FROM conversations)"""
    sql["conversation_arcs"] = f"""WITH {LEXICONS}, {turns}, {word_ctes_listed("turns")}, {score_ctes("split")}
      SELECT {key}, {emotions}, {rs(AVG_D)}, vad_word_count FROM scores"""

    # trajectories
    sql["chunk_normalize"] = f"WITH {TRAJ} SELECT book_id, chunk_index, {emotions}, {rs(NORMS)} FROM normal"
    sql["analyze_trajectory"] = f"""WITH {TRAJ} SELECT book_id, title, author, {rs(AVERAGES)}, num_chunks, {rs(RATIOS)},
      CAST(length(emotion_trajectory) AS INTEGER) AS points, {r("list_sum(flatten(emotion_trajectory))", "arc_sum")} FROM traj"""
    points = f"WITH {TRAJ} SELECT book_id, chunk_index, {rs(NORMS)} FROM normal"
    sql["trajectory_points"] = points
    sql["trajectory_points_long"] = points
    split_books = """split_books AS (SELECT book_id || '/whole' AS book_id, title, author, text FROM books
      UNION ALL SELECT book_id || '/half', title, author, substring(text, 1, length(text) // 2) FROM books
      WHERE CAST(book_id AS INTEGER) % 3 = 0 AND length(text) // 2 < length(text))"""
    versions = ",".join(
        [LEXICONS, BOOKS, split_books, chunk_ctes("split_books"), word_ctes_listed("chunks"), score_ctes("split"), trajectory_ctes("scores")]
    )
    sql["book_versions"] = f"""WITH {versions} SELECT split_part(book_id, '/', 1) AS book_id, title, num_chunks, {rs(AVERAGES)}, {rs(RATIOS)} FROM plain"""
    sql["book_versions_by_words"] = f"""WITH {versions} SELECT split_part(book_id, '/', 1) AS book_id, max(num_chunks) AS num_chunks,
      count(*) AS versions, true AS chosen FROM plain GROUP BY 1"""
    sql["emotion_ratios"] = f"WITH {TRAJ} SELECT book_id, {rs(RATIOS)} FROM traj"

    def dominant(names) -> str:
        ranked = ", ".join(
            f"{{'k': -avg_{e}, 'i': {i}, 'n': '{e}'}}"
            for i, e in enumerate(("joy", "trust", "anticipation", "surprise", "sadness", "fear", "anger", "disgust"))
            if e in names
        )
        return f"""array_to_string(list_transform(list_filter((list_sort([{ranked}]))[1:3], lambda s: s.k < 0),
          lambda s: s.n), '|')"""

    tone = "CASE WHEN round(avg_valence + 1e-12, 9) > 0.05e0 THEN 'positive' WHEN round(avg_valence + 1e-12, 9) < -0.05e0 THEN 'negative' ELSE 'neutral' END"
    energy = "CASE WHEN round(avg_arousal + 1e-12, 9) > 0.05e0 THEN 'high-energy' WHEN round(avg_arousal + 1e-12, 9) < -0.05e0 THEN 'calm' ELSE 'moderate' END"
    sql["emotional_profile"] = f"""WITH {TRAJ} SELECT book_id, title, author, {tone} AS tone, {energy} AS energy,
      {dominant(EMOTIONS)} AS dominant, {rs(RATIOS)} FROM traj"""
    sql["dominant_emotions"] = f"""WITH {TRAJ} SELECT book_id, {dominant(EMOTIONS)} AS dominant,
      {dominant(("joy", "trust", "fear", "sadness"))} AS dominant_of_four,
      {dominant(("joy", "trust", "anticipation", "fear", "sadness"))} AS dominant_of_five FROM traj"""
    sql["tone_energy"] = f"WITH {TRAJ} SELECT book_id, {tone} AS tone, {energy} AS energy FROM traj"
    sql["dedupe_books"] = f"""WITH {TRAJ} SELECT book_id,
      CASE WHEN book_embedding IS NULL THEN 'Copy of ' || title ELSE title END AS title, num_chunks, {r("avg_joy")},
      CAST(coalesce(length(book_embedding), 0) AS INTEGER) AS dimensions FROM traj"""
    sql["adhoc_text_input"] = f"""WITH {LEXICONS}, {ADHOC}
      SELECT book_id, title, author, num_chunks, {rs(AVERAGES)}, {rs(RATIOS)} FROM q_plain"""
    stories = f"""stories AS (SELECT 'my_story_' || item_id || '.txt' AS book_id, 'my story ' || item_id AS title, 'File Input' AS author,
      text || chr(10) AS text FROM benchmark WHERE length(text) > 0)"""
    own_chunks = [chunk_ctes("stories", ADAPTIVE), word_ctes_listed("chunks"), score_ctes("split"), trajectory_ctes("scores")]
    # A chunk without a word of the vocabulary is in no topic.
    known = """known AS (SELECT w FROM (SELECT book_id, chunk_index, unnest(list_distinct(words)) AS w FROM split) GROUP BY w HAVING count(*) >= 2),
      in_topics AS (SELECT s.book_id, count(DISTINCT t.chunk_index) / count(DISTINCT s.chunk_index) AS share FROM split s
        LEFT JOIN (SELECT book_id, chunk_index FROM (SELECT book_id, chunk_index, unnest(words) AS w FROM split) u JOIN known USING (w)) t
        ON t.book_id = s.book_id AND t.chunk_index = s.chunk_index GROUP BY s.book_id)"""
    sql["adhoc_files"] = f"""WITH {LEXICONS}, {stories}, {",".join(own_chunks)}, {known}
      SELECT plain.book_id, title, author, num_chunks, {rs(AVERAGES)}, num_chunks AS scored_chunks, 3 AS topics, {r("share", "in_topics")}
      FROM plain JOIN in_topics ON in_topics.book_id = plain.book_id"""
    one_book = f"one_book AS (SELECT book_id, title, author, text || chr(10) AS text FROM books WHERE book_id = {LIKED})"
    own = ",".join([chunk_ctes("one_book", ADAPTIVE, "q_"), word_ctes_listed("q_chunks", "q_"), score_ctes("q_split", "q_"), trajectory_ctes("q_scores", "q_")])
    gaps = " + ".join(f"pow((b.{c} - q.{c}) * {w}e0, 2)" for c, w in WEIGHTS.items())
    sql["adhoc_book_by_id"] = f"""WITH {TRAJ}, {one_book}, {own},
      near AS (SELECT b.book_id, 1e0 / (1e0 + sqrt({gaps})) AS s FROM traj b, q_plain q WHERE b.book_id <> {LIKED}),
      best AS (SELECT book_id, round(s + 1e-12, 9) AS s FROM near ORDER BY 2 DESC, 1 LIMIT 10)
      SELECT book_id, title, author, num_chunks, {rs(AVERAGES)}, (SELECT string_agg(book_id, '|' ORDER BY s DESC, book_id) FROM best) AS hits FROM q_plain"""
    fresh = ",".join(
        [
            chunk_ctes("books", ADAPTIVE, "q_"), word_ctes_listed("q_chunks", "q_"),
            score_ctes("q_split", "q_"), trajectory_ctes("q_scores", "q_"),
        ]
    )
    sql["stored_or_fresh_input"] = f"""WITH {TRAJ}, {fresh}
      SELECT book_id, num_chunks, {rs(AVERAGES)} FROM traj WHERE book_id IN ({LABELLED})
      UNION ALL SELECT book_id, num_chunks, {rs(AVERAGES)} FROM q_plain WHERE book_id NOT IN ({LABELLED})"""
    sql["union_query_row"] = f"""WITH {TRAJ}, {ADHOC}
      SELECT book_id, title, num_chunks, {r("avg_joy")}, CAST(coalesce(length(book_topics), 0) AS INTEGER) AS topics FROM traj
      UNION ALL SELECT book_id, title, num_chunks, {r("avg_joy")}, 0 FROM q_plain"""
    sql["attach_vectors"] = f"""WITH {TRAJ}
      SELECT book_id, num_chunks, CAST(unnest(range(length(book_embedding))) AS INTEGER) AS i,
        round(unnest(book_embedding) + 1e-10, 6) AS embedding, round(unnest(book_topics) + 1e-10, 6) AS topic
      FROM traj WHERE book_embedding IS NOT NULL
      UNION ALL SELECT book_id, num_chunks, -1, NULL, NULL FROM traj WHERE book_embedding IS NULL"""

    # similarity
    one = f"WITH {TRAJ}, {pair_cte(LIKED)} SELECT book_id, "
    sql["feature_similarity"] = f"{one} title, author, {r('s_feature', 'feature_similarity')} FROM pairs"
    for name in ("trajectory", "embedding", "topic"):
        sql[f"{name}_similarity"] = f"{one} {r(f's_{name}', f'{name}_similarity')} FROM pairs"
    sql["arc_similarity"] = f"""WITH {TRAJ}, {pair_cte(LIKED, arc=shape)}
      SELECT book_id, {r("s_trajectory", "trajectory_similarity")} FROM pairs"""
    sql["genre_similarity"] = f"""WITH {BOOKS}, {genre_cte(LIKED)}
      SELECT book_id, {r("s_genre", "genre_similarity")} FROM genres"""
    bounds = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in AVERAGES)
    squares = " + ".join(
        f"CASE WHEN hi_{c} > lo_{c} THEN pow((b.{c} - q.{c}) / (hi_{c} - lo_{c}), 2) ELSE 0e0 END" for c in AVERAGES
    )
    sql["feature_similarity_minmax"] = f"""WITH {TRAJ}, bounds AS (SELECT {bounds} FROM traj WHERE book_id <> {LIKED})
      SELECT b.book_id, b.title, b.author, {r(f"1e0 / (1e0 + sqrt({squares}))", "feature_similarity")},
        round(b.avg_dominance + 1e-10, 6) AS avg_dominance
      FROM traj b, traj q, bounds WHERE q.book_id = {LIKED} AND b.book_id <> {LIKED}"""
    sql["similarity_bucket"] = f"""{one} {r("s_feature", "feature_similarity")},
      CASE WHEN round(s_feature + 1e-12, 9) > 0.9e0 THEN 'very similar' WHEN round(s_feature + 1e-12, 9) > 0.8e0 THEN 'similar'
           WHEN round(s_feature + 1e-12, 9) > 0.7e0 THEN 'related' ELSE 'loosely related' END AS bucket FROM pairs"""

    # recommendation
    sql["recommend"] = f"""WITH {TRAJ}, {joined_pairs(LIKED)}
      SELECT book_id, title, author, {r("similarity")}, {rs(AVERAGES)} FROM scored {top("similarity", 10)}"""
    sql["recommend_from_text"] = f"""WITH {TRAJ}, {pair_cte(LIKED)}
      SELECT book_id, title, author, {r("s_feature", "similarity")} FROM pairs {top("s_feature", 10)}"""
    present = "(0.65e0 + CASE WHEN book_embedding IS NULL THEN 0e0 ELSE 0.15e0 END" \
        " + CASE WHEN book_topics IS NULL THEN 0e0 ELSE 0.1e0 END)"
    sql["recommend_shape"] = f"""WITH {TRAJ}, {pair_cte(LIKED, arc=shape)},
      s AS (SELECT *, {blend("similar_experience", genre=False)} / {present} AS similarity FROM pairs)
      SELECT book_id, title, {r("similarity")} FROM s {top("similarity", 10)}"""
    sql["recommend_batch"] = f"WITH {HITS} SELECT query_id, rank, book_id, title, {r('similarity')} FROM hits"
    sql["recommend_missing_id"] = f"""WITH {BOOKS} SELECT book_id, title, author, 0e0 AS similarity
      FROM books WHERE false"""
    sql["recommend_adhoc"] = f"""WITH {TRAJ}, {ADHOC},
      everything AS (SELECT * FROM traj UNION ALL BY NAME SELECT * FROM q_plain WHERE book_id = 'text_file_0'),
      {pair_cte("'text_file_0'", "everything")}
      SELECT book_id, title, author, {r(blend("balanced", genre=False), "similarity")} FROM pairs
      {top(blend("balanced", genre=False), 10)}"""
    by_preset = " UNION ALL ".join(
        f"SELECT query_id, book_id, title, '{p}' AS preset, {blend(p)} AS sim FROM scored" for p in PRESETS
    )

    def presets(ids: str, n: int) -> str:
        return f"""WITH {TRAJ}, {joined_pairs(ids)}, long AS ({by_preset}),
          ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, preset
             ORDER BY round(sim + 1e-12, 9) DESC, book_id) AS INTEGER) AS rank FROM long),
          best AS (SELECT * FROM ranked WHERE rank <= {n})"""

    sql["preset_comparison"] = f"""{presets(LIKED, 5)}
      SELECT query_id, preset, rank, book_id, title, {r("sim", "similarity")} FROM best"""
    sql["weight_presets"] = f"""{presets(TEST_BOOKS, 1)} SELECT query_id, preset, book_id,
      CASE WHEN round(sim + 1e-12, 9) > 0.9e0 THEN 'very similar' WHEN round(sim + 1e-12, 9) > 0.8e0 THEN 'similar' WHEN round(sim + 1e-12, 9) > 0.7e0 THEN 'related'
           ELSE 'loosely related' END AS bucket FROM best"""

    # exploration
    found = f"WITH {BOOKS} SELECT book_id, title, author FROM books WHERE"
    sql["title_search"] = f"{found} title LIKE '%ment 1%' ORDER BY book_id LIMIT 20"
    sql["title_search_ci"] = f"{found} title ILIKE '%DOCUMENT 2%' ORDER BY book_id LIMIT 20"
    shown = ["avg_joy", "avg_sadness", "avg_fear", "avg_anger", "avg_valence", "avg_arousal"]
    sql["top_by_emotion"] = f"WITH {TRAJ} SELECT book_id, title, author, {rs(shown)} FROM traj {top('traj.avg_joy', 20)}"
    extremes = " UNION ALL ".join(
        f"""SELECT '{label}' AS label, title, author, {r(column, "value")} FROM
          (SELECT * FROM traj ORDER BY round({column} + 1e-12, 9) {order}, book_id LIMIT 1)"""
        for label, column, order in (
            ("Happiest", "ratio_joy", "DESC"),
            ("Saddest", "ratio_sadness", "DESC"),
            ("Most Exciting", "avg_arousal", "DESC"),
            ("Calmest", "avg_arousal", "ASC"),
            ("Most Positive", "avg_valence", "DESC"),
            ("Most Negative", "avg_valence", "ASC"),
            ("Most Intense", "avg_dominance", "DESC"),
        )
    )
    sql["superlatives"] = f"WITH {TRAJ} {extremes}"
    ranges = f"""ranges AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in AVG_E)} FROM traj)"""

    def match(levels: dict[str, float], unit: bool = False) -> str:
        parts = []
        for e, level in levels.items():
            lo, hi, width = f"lo_avg_{e}", f"hi_avg_{e}", f"(hi_avg_{e} - lo_avg_{e})"
            book = f"CASE WHEN {hi} > {lo} THEN (avg_{e} - {lo}) / {width} ELSE 0.5e0 END"
            want = f"{level}e0" if unit else f"CASE WHEN {hi} > {lo} THEN ({level}e0 - {lo}) / {width} ELSE 0.5e0 END"
            parts.append(f"pow(({book}) - ({want}), 2)")
        return f"1e0 / (1e0 + sqrt({' + '.join(parts)}))"

    bucket = """CASE WHEN round(match_score + 1e-12, 9) > 0.8e0 THEN 'excellent' WHEN round(match_score + 1e-12, 9) > 0.6e0 THEN 'good'
      WHEN round(match_score + 1e-12, 9) > 0.4e0 THEN 'fair' ELSE 'partial' END AS bucket"""
    wanted = {"joy": 0.7, "sadness": 0.4}
    sql["preference_match"] = f"""WITH {TRAJ}, {ranges}, m AS (SELECT *, {match(wanted)} AS match_score FROM traj, ranges)
      SELECT book_id, title, author, {r("match_score")}, {rs(AVERAGES)} FROM m {top("m.match_score", 20)}"""
    sql["preference_match_unit"] = f"""WITH {TRAJ}, {ranges},
      m AS (SELECT *, {match(wanted, unit=True)} AS match_score FROM traj, ranges)
      SELECT book_id, {r("match_score")}, {bucket} FROM m {top("m.match_score", 20)}"""
    vibes = {
        "Balanced": {"joy": 0.5, "anticipation": 0.5, "surprise": 0.3, "trust": 0.5},
        "Cozy & Uplifting": {"joy": 0.7, "anticipation": 0.6, "surprise": 0.2, "trust": 0.6},
        "Adventurous": {
            "joy": 0.5, "anticipation": 0.7, "surprise": 0.5, "trust": 0.4, "sadness": 0.1, "fear": 0.2,
        },
        "Dark & Tense": {
            "joy": 0.1, "anticipation": 0.4, "surprise": 0.3, "trust": 0.2,
            "sadness": 0.5, "fear": 0.5, "anger": 0.2, "disgust": 0.2,
        },
        "Surprising": {"joy": 0.4, "anticipation": 0.6, "surprise": 0.7, "trust": 0.3, "fear": 0.1},
    }
    by_vibe = " UNION ALL ".join(
        f"SELECT book_id, title, author, '{v}' AS vibe, {match(levels)} AS match_score FROM traj, ranges"
        for v, levels in vibes.items()
    )
    sql["vibe_match"] = f"""WITH {TRAJ}, {ranges}, long AS ({by_vibe}),
      ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY vibe ORDER BY round(match_score + 1e-12, 9) DESC, book_id)
        AS INTEGER) AS rank FROM long)
      SELECT vibe, rank, book_id, title, author, round(match_score + 1e-10, 6) AS match_score, {bucket}
      FROM ranked WHERE rank <= 20"""

    # evaluation
    def distribution(label: str, columns: dict[str, str]) -> str:
        return " UNION ALL ".join(
            f"""SELECT '{n}' AS {label}, round(avg({c}) + 1e-10, 6) AS mean, round(coalesce(stddev_samp({c}), 0e0) + 1e-10, 6) AS std,
            round(min({c}) + 1e-10, 6) AS min, round(max({c}) + 1e-10, 6) AS max FROM traj"""
            for n, c in columns.items()
        )

    sql["emotion_distribution"] = f"WITH {TRAJ} {distribution('emotion', {e: f'ratio_{e}' for e in EMOTIONS})}"
    sql["vad_distribution"] = f"WITH {TRAJ} {distribution('dimension', {c[4:]: c for c in AVG_D})}"
    sql["overall_tone"] = f"""WITH {TRAJ} SELECT CASE WHEN avg(avg_valence) > 0 THEN 'positive' ELSE 'negative' END AS tone,
      CASE WHEN avg(avg_arousal) > 0 THEN 'high energy' ELSE 'calm' END AS energy,
      round(avg(avg_valence) + 1e-10, 6) AS valence, round(avg(avg_arousal) + 1e-10, 6) AS arousal FROM traj"""
    sql["query_quality"] = f"""WITH {HITS} SELECT query_id, max(book_id) FILTER (rank = 1) AS top_rec_id,
      max(title) FILTER (rank = 1) AS top_recommendation, round(max(similarity) FILTER (rank = 1) + 1e-10, 6) AS top_similarity,
      round(avg(similarity) FILTER (rank <= 5) + 1e-10, 6) AS avg_top5_similarity,
      string_agg(book_id, '|' ORDER BY rank) FILTER (rank <= 5) AS top_5 FROM hits GROUP BY query_id"""
    stats = """SELECT count(*) AS n, round(avg(similarity) + 1e-10, 6) AS mean,
      round((list(similarity ORDER BY similarity))[count(*) // 2 + 1] + 1e-10, 6) AS median,
      round(stddev_pop(similarity) + 1e-10, 6) AS std, round(min(similarity) + 1e-10, 6) AS min, round(max(similarity) + 1e-10, 6) AS max,
      round((list(similarity ORDER BY similarity))[count(*) // 4 + 1] + 1e-10, 6) AS p25,
      round((list(similarity ORDER BY similarity))[3 * count(*) // 4 + 1] + 1e-10, 6) AS p75 FROM hits"""
    sql["similarity_stats"] = f"WITH {HITS} {stats}"
    mutual = """SELECT count(*) AS pairs, round(coalesce(avg(CASE WHEN y.book_id = x.query_id THEN 1e0 ELSE 0e0 END), 0e0) + 1e-10, 6)
      AS reciprocity_rate FROM hits x JOIN hits y ON x.book_id = y.query_id WHERE x.rank = 1 AND y.rank = 1"""
    sql["reciprocity"] = f"WITH {HITS} {mutual}"
    sql["evaluation_report"] = f"""WITH {HITS}, stats AS ({stats}), mutual AS ({mutual}),
      tested AS (SELECT count(DISTINCT query_id) AS t FROM hits)
      SELECT CAST(t AS INTEGER) AS books_tested, CAST(15 - t AS INTEGER) AS books_skipped, reciprocity_rate, stats.* FROM tested, mutual, stats"""
    six = "round({} + 1e-10, 6)"
    liked_hits = ", ".join(
        f"SELECT query_id, book_id, {blend(p)} AS sim, '{p}' AS preset FROM scored WHERE query_id = {LIKED}" for p in PRESETS
    ).replace(", SELECT query_id", " UNION ALL SELECT query_id")
    dist = " UNION ALL ".join(
        [f"SELECT 'emotion_distribution', '{e}', '', {six.format(f'avg(ratio_{e})')} FROM traj" for e in EMOTIONS]
        + [f"SELECT 'vad_distribution', '{c[4:]}', '', {six.format(f'avg({c})')} FROM traj" for c in AVG_D]
    )
    sql["evaluation_report_full"] = f"""WITH {HITS}, stats AS ({stats}), mutual AS ({mutual}), extremes AS ({extremes}), liked AS ({liked_hits}),
      ranked_liked AS (SELECT *, row_number() OVER (PARTITION BY preset ORDER BY round(sim + 1e-12, 9) DESC, book_id) AS rank FROM liked)
      SELECT 'corpus' AS part, '' AS name, '' AS what, CAST(count(*) AS DOUBLE) AS value FROM traj
      UNION ALL SELECT 'quality', 'books_tested', '', CAST(count(DISTINCT query_id) AS DOUBLE) FROM hits
      UNION ALL SELECT 'quality', 'books_skipped', '', CAST(16 - count(DISTINCT query_id) AS DOUBLE) FROM hits
      UNION ALL SELECT 'quality', 'reciprocity_rate', '', reciprocity_rate FROM mutual
      UNION ALL SELECT 'book', query_id, 'Document ' || query_id || '|' || max(book_id) FILTER (rank = 1) || '|' || string_agg(book_id, '|' ORDER BY rank) FILTER (rank <= 5),
        {six.format("avg(similarity) FILTER (rank <= 5)")} FROM hits GROUP BY query_id
      UNION ALL SELECT 'preset', preset, string_agg(book_id, '|' ORDER BY rank), {six.format("max(sim) FILTER (rank = 1)")} FROM ranked_liked WHERE rank <= 5 GROUP BY preset
      UNION ALL {dist} UNION ALL SELECT 'superlative', label, title, value FROM extremes"""
    sql["corpus_counts"] = f"""WITH {TRAJ} SELECT 'books' AS what, count(*) AS n FROM traj
      UNION ALL SELECT 'chunks', count(*) FROM scores UNION ALL SELECT 'emotion_pairs', count(*) FROM emo
      UNION ALL SELECT 'vad_terms', count(*) FROM vad UNION ALL SELECT 'catalogue', count(*) FROM books
      UNION ALL SELECT 'stored_query', count(*) FROM traj WHERE book_id = {LIKED}"""

    # vectors and models
    sql["vector_mean"] = """SELECT label, CAST(i - 1 AS INTEGER) AS i, round(avg(v) + 1e-10, 6) AS mean FROM (
      SELECT label, unnest(range(1, length(embedding) + 1)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
      GROUP BY label, i"""
    sql["topic_rank"] = f"""WITH {TRAJ}, long AS (SELECT book_id, unnest(book_topics) AS weight,
        unnest(range(1, length(book_topics) + 1)) AS topic FROM traj WHERE book_topics IS NOT NULL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY weight DESC, topic) AS rank FROM long)
      SELECT book_id, CAST(rank AS INTEGER) AS rank, CAST(topic AS INTEGER) AS topic, round(weight + 1e-10, 6) AS weight
      FROM ranked WHERE rank <= 5"""
    vocabulary = """vocabulary AS (SELECT w FROM (SELECT book_id, chunk_index, unnest(list_distinct(words)) AS w FROM split)
      GROUP BY w HAVING count(*) >= 2)"""
    counts = f"""WITH {words}, {vocabulary}
      SELECT w AS word, count(t.w) AS n FROM vocabulary JOIN (SELECT unnest(words) AS w FROM split) t USING (w) GROUP BY w"""
    sql["term_counts"] = sql["vocabulary_counts"] = counts
    sql["word2vec_twins"] = f"""{counts.replace("SELECT w AS word", ", counted AS (SELECT w AS word")}),
      frequent AS (SELECT word FROM counted ORDER BY n DESC, word LIMIT 8)
      SELECT word, word || '_twin' AS nearest FROM frequent UNION ALL SELECT word || '_twin', word FROM frequent"""
    sql["word2vec_fit"] = f"""WITH {words}
      SELECT w AS word FROM (SELECT unnest(words) AS w FROM split) GROUP BY w HAVING count(*) >= 5"""
    sql["chunk_embeddings"] = f"WITH {words} SELECT book_id, chunk_index, 100 AS dimensions, true AS is_mean FROM split"
    sql["chunk_topics"] = f"WITH {words} SELECT book_id, chunk_index, 10 AS topics, true AS is_mixture FROM split"
    sql["lda_fit"] = f"""WITH {words}, {vocabulary} SELECT CAST(i AS INTEGER) AS topic, CAST(least(20, n) AS INTEGER) AS terms,
      true AS are_shares, true AS is_better FROM range(10) t(i), (SELECT count(*) AS n FROM vocabulary)"""
    sql["book_topics"] = f"WITH {BOOKS} SELECT book_id, 10 AS size, true AS is_mean FROM books WHERE length(text) > 0"
    sql["book_embeddings"] = f"WITH {BOOKS} SELECT book_id, 100 AS size, true AS is_mean FROM books WHERE length(text) > 0"
    sql["model_reuse"] = f"""WITH {BOOKS} SELECT book_id, least(length(text), 20) AS num_chunks, 100 AS dimensions,
      10 AS topics, true AS is_mean_of_words, true AS is_mean_of_topics FROM books WHERE length(text) > 0"""
    sql["incremental_ingest_models"] = sql["model_reuse"]
    sql["model_roundtrip"] = f"""WITH {BOOKS} SELECT book_id, true AS same_embedding, true AS same_topics
      FROM books WHERE length(text) > 0"""

    # streaming
    sql["incremental_ingest"] = f"""WITH {TRAJ}
      SELECT book_id, title, author, num_chunks, {rs(AVERAGES)}, {rs(RATIOS)} FROM plain"""
    return sql
