"""Stop-word lists."""

from __future__ import annotations

# The public NLTK English stop words, used by the word reports.
ENGLISH = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him
his himself she she's her hers herself it it's its itself they them their theirs themselves what which who
whom this that that'll these those am is are was were be been being have has had having do does did doing a
an the and but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own same so than too very s t
can will just don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Words added to Spark's English list before training.
MODEL_EXTRA = ["i", "we", "he", "she", "is", "like", "and", "the"]

# The short list of the notebook models, used instead of Spark's list.
MODEL_SHORT = ["is", "like", "and", "the"]

# Words of Spark's English list that the NLTK list lacks, used by the exploration reports.
SPARK_ONLY = """
i'll he'll she'll we'll they'll i'd he'd she'd we'd they'd i'm he's we're they're i've we've they've can't
cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()

# Words of the NLTK list that Spark's English list lacks.
NLTK_ONLY = """
ain aren couldn d didn doesn hadn hasn haven isn ll m ma mightn mightn't mustn needn needn't o re shan should've
shouldn that'll ve wasn weren won wouldn y
""".split()

# Forum words dropped by the exploration reports ("people" and "get" are two words).
FORUM = """
want really u go s still sounds like make sure feel maybe need bot action performed automatically please
contact message compose questions even though many one someone people get also us might let know
""".split()

EXPLORATION = list(dict.fromkeys(ENGLISH + SPARK_ONLY + MODEL_EXTRA + FORUM))


def spark_english() -> list[str]:
    """Spark ML's own English list; needs a running session."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")
