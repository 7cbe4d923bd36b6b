"""DataFrame operators built on the split rule: lake range splits and plan reports."""
