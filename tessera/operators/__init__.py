"""DataFrame operators.

* ``relational``  - rating queries, stacked filters, set difference, computed columns
* ``text_index``  - per-document term counts and block-bounded posting lists
* ``traffic``     - strict parsing of tab-separated logs and per-key totals
* ``cells``       - wide-column cell tables: put, merge, get, delete
* ``placement``   - batch slots and task placement
* ``ranking``     - distributed running sums and positions in a sort order
* ``manifest``    - file manifests: rebase, parents, copy plan, sizes, names, times, globs
* ``copy``        - the distributed copy and its status table
* ``layout``      - scans re-dealt on the caller's setting
"""
