"""adtrail.plans"""
