"""``spark-submit run_job.py QUESTION ...``; see ``--help``."""

from tarmac.cli import main

if __name__ == "__main__":
    main()
