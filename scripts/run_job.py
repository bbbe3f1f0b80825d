"""spark-submit entry point: ``spark-submit --py-files shopstream.zip scripts/run_job.py <job> ...``
(arguments as for ``python -m shopstream.streaming.apps``)."""

import sys

from shopstream.streaming.apps import main

if __name__ == "__main__":
    main(sys.argv[1:])
