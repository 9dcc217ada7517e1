"""txnlens: table operators for transaction-risk analytics, written as Spark plans."""
