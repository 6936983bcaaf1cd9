"""acctflow: account, sales and payment analytics as Spark DataFrame operators.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame. Outside ``acctflow.llm`` only counts reach the driver: the size of
contracted edges and one number per connected-components round.
"""

from acctflow.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
