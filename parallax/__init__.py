"""parallax: parallel-text corpus preparation, lexical models and evaluation as Spark jobs.

Layout
------
sources/    table feeds, CSV/TSV readers and writers, artifacts
functions/  Column-level helpers (tokenizers, vector math, masks)
operators/  DataFrame -> DataFrame operators (cleaning, splits, vocabulary,
            encoding, batching, attention pooling)
plans/      multi-step jobs (lexical translation, bigram model, decoding,
            evaluation)
streaming/  Structured Streaming jobs
"""

from parallax.session import get_session, checkpoint_dir, scratch_path  # noqa: F401
