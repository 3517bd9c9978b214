"""The operators' queries and SQL, for __spark_entry__.py."""

from .chat import op8_chat, op8_sql
from .fingerprint import op4_fingerprints
from .licenses import op3_licenses
from .lines import OP12_SQL, op12_lines
from .mixing import op1_mix
from .neardup import OP6_SQL, op6_neardup
from .packing import op9_packing
from .periodic import op13_periodic
from .pii import op7_pii
from .quality import op10_quality
from .repair import OP11_SQL, op11_repair
from .secrets import op2_secrets
from .warc import OP5_SQL, op5_warc

QUERIES = {f.__name__: f for f in (op1_mix, op2_secrets, op3_licenses, op4_fingerprints, op5_warc, op6_neardup, op7_pii, op8_chat, op9_packing, op10_quality, op11_repair, op12_lines, op13_periodic)}
SQL = {"op5_warc": OP5_SQL, "op6_neardup": OP6_SQL, "op8_chat": op8_sql(), "op11_repair": OP11_SQL, "op12_lines": OP12_SQL}
