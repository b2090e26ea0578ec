"""Query plans: the registered, named queries over the given tables (see ``registry``)."""

from quire.plans import q_text  # noqa: F401
from quire.plans import q_blocks  # noqa: F401
from quire.plans import q_structured  # noqa: F401
from quire.plans import q_entities  # noqa: F401
from quire.plans import q_retrieval  # noqa: F401
from quire.plans import q_flow  # noqa: F401
from quire.plans import q_more  # noqa: F401
