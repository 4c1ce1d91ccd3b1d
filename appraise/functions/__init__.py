"""Column-expression helpers (all JVM-side ``pyspark.sql.functions`` compositions)."""

from appraise.functions.hashing import keyed_hash, keyed_uniform, HASH_SPACE  # noqa: F401
from appraise.functions import rsem  # noqa: F401
