"""Column-expression library (kinematics, image geometry)."""

from collidex.functions.kinematics import *  # noqa: F401,F403
