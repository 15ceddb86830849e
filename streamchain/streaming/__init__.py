"""The same operators on live logs."""
