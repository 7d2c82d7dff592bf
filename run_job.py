"""Entry point for ``spark-submit``; see ``gridledger/plans/jobs.py``."""

from gridledger.plans.jobs import main

if __name__ == "__main__":
    main()
