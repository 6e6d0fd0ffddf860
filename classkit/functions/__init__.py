from classkit.functions.scores import (  # noqa: F401
    argmax,
    bind,
    centred_unit,
    clipped_log_loss,
    edge_width,
    edge_width_clipped,
    logistic,
    positive_probability,
    softmax,
    threshold,
)
