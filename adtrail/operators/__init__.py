"""adtrail.operators"""
