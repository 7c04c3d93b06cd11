"""quern: DataFrame operators that turn document collections into supervised fine-tuning data."""
