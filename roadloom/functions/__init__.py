"""Scalar functions over points: JVM expressions (``points``) and numpy kernels (``polylines``)."""
