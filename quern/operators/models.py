"""Models that need nothing installed; real ones plug in by their class path."""


class EchoModel:
    """Answers with the first sentence of its text."""

    def __call__(self, pdf):
        return pdf[["doc_id", "ord"]].assign(answer=[t.split(".")[0] for t in pdf["text"]])


class NamedModel:
    """Answers with the name of the model that was asked for, and the question."""

    def __call__(self, pdf):
        return pdf[["question_id", "model_name"]].assign(answer=pdf["model_name"] + ": " + pdf["question"])
