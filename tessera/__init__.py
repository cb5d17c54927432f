"""tessera: a Spark-native knowledge-base, retrieval and conversation engine.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
public DataFrame / SQL API so Catalyst can prune, push down and fuse it.
The names below are the user-facing entry points (one per original
operation); everything else lives in ``tessera.functions``,
``tessera.operators``, ``tessera.sources``, ``tessera.plans`` and
``tessera.streaming``.
"""

__version__ = "0.1.0"

from tessera.functions.filters import compile_filter  # noqa: E402,F401
from tessera.functions.prompt import render_prompts  # noqa: E402,F401
from tessera.operators.embed import hash_embed, model_embed  # noqa: E402,F401
from tessera.operators.infer import coerce_output, complete  # noqa: E402,F401
from tessera.operators.parse import parse  # noqa: E402,F401
from tessera.operators.search import search_one, vector_topk, vector_topk_approx  # noqa: E402,F401
from tessera.operators.split import split_documents  # noqa: E402,F401
from tessera.plans.knowledge import (add_to_knowledge, add_to_store,  # noqa: E402,F401
                                     get_from_knowledge, rag_chat, rag_context)
