"""tessera: DataFrame operators for star-schema rating queries, inverted
indexes, per-key traffic totals, wide-column cell tables and planned file
copies, all running as plain Spark jobs.

Sub-packages:

* ``sources``   - readers (delimited text, text lines, whole files, file manifests)
* ``functions`` - Column-expression helpers (strict int parsing, path algebra)
* ``operators`` - the relational, text-index, traffic, cell, placement,
                  manifest and copy operators
* ``sinks``     - writers (key/value text, compaction)
* ``plans``     - stand-in views over the test tables and the registered queries
* ``streaming`` - the traffic totals over a growing folder of log files
"""

from tessera.session import build_session, checkpoint_dir

__version__ = "0.1.0"
__all__ = ["build_session", "checkpoint_dir", "__version__"]
